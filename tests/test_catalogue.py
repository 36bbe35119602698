"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

from sightline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings manifest route_b entities grounded_entities expression_drafts eval_items mix_targets".split()


@pytest.fixture(scope="module")
def sql(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, data, sql, name):
    df = catalogue.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.oracle_sql():
        assert got
        return
    cur = sql.execute(catalogue.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(_plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())


def test_no_cross_joins(spark, data):
    for name in ("pair_match", "duplicate_suspects", "unmatched_boxes", "competitors", "near_rows", "geometry_audit", "box_metrics"):
        plan = catalogue.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_read_what_they_need(spark, data):
    df = catalogue.queries()["ocr_completeness"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "caption_span" not in plan and "used_relation" not in plan


def test_entry_point_lists_every_query(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e

    assert set(catalogue.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
