"""Every registered query of the subpackage that has SQL against it, on the smallest tables."""

import duckdb
import pytest

from sightline.llm import queries


@pytest.fixture(scope="module")
def sql(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in "manifest route_b entities grounded_entities expression_drafts documents eval_items mix_targets".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def _plain(v):
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, data, sql, name):
    df = queries.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    cur = sql.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(_plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
