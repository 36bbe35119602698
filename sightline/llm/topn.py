"""Top N items within every group by statistics-guided skipping.

The items are clustered by group into Parquet files. Which score a group's N-th item reaches at least is told beforehand
from counts, so that groups of like N-th scores lie together; within them the row groups run from high to low scores. Each
file is then read row group by row group in descending maximum score. A row group whose maximum lies strictly below the
current N-th score of every group it contains is skipped: of it no more than the column of groups is read, and not even
that where its statistics name one group only. Groups that hold much of the data are spread over several files and their
few survivors are merged at the end, so no task ever holds a whole large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sightline.session import scratch_path, written

ROWS_PER_FILE = 2_000_000  # rows of one file before more files are made
ROW_GROUP_ROWS = (1_000, 50_000)  # least and most rows of a row group; in between, a sixteenth of a file
STEPS = 16  # scores at which the items of a group are counted beforehand


def plain_number(c: Column) -> Column:
    """``c`` as double, with NaN turned into null."""
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def score_bound(first: Column, second: Column, whole: bool = True) -> Column:
    """A double that never falls where (first, second) rises, both with nulls lowest.

    ``second`` is squashed into (-1, 1), so a step of ``first`` by one whole number outweighs it. Where ``first`` may have
    fractions (not ``whole``) the bound is ``first`` alone. Different pairs may share a bound; only strictly smaller bounds
    prove a smaller pair.
    """
    low = F.lit(-1.7e308)
    if not whole:
        return F.coalesce(first, F.lit(float("-inf")))
    squashed = F.when(second.isNull(), F.lit(-1.0)).when(F.abs(second) == float("inf"), F.signum(second)).otherwise(second / (F.abs(second) + 1))
    return F.when(first.isNull(), low).otherwise(first * 2) + F.coalesce(squashed, F.lit(1.0))


def latest_rows(df: DataFrame, key: str, at: str, then: str, *columns: str) -> DataFrame:
    """For each ``key`` the row with the latest ``at``; among equal ones the latest ``then``, then the greatest values.

    Null keys are dropped. One row per key crosses the shuffle from each task (partial maximum).
    """
    best = F.max(F.struct(at, then, *columns)).alias("_best")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *(F.col("_best")[c].alias(c) for c in columns))


def _file_system(uri: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(uri)


def scan_clustered(uri: str, n: int) -> tuple[pd.DataFrame, int, int]:
    """The top ``n`` of every group in one clustered file, with the row groups read and skipped.

    Columns of the file: _group, _bound, _first, _second, _item. Order: first and second descending with nulls last,
    then item ascending by code points.
    """
    import pyarrow.parquet as pq

    columns = ["_group", "_bound", "_first", "_second", "_item"]
    fs, path = _file_system(uri)
    with fs.open_input_file(path) as handle:
        source = pq.ParquetFile(handle)
        names = source.schema_arrow.names
        g_at, b_at = names.index("_group"), names.index("_bound")
        parts = []
        for k in range(source.num_row_groups):
            meta = source.metadata.row_group(k)
            g, b = meta.column(g_at).statistics, meta.column(b_at).statistics
            told = g is not None and g.has_min_max
            parts.append((b.max if b is not None and b.has_min_max else float("inf"), k, g.min if told and g.min == g.max else None))
        parts.sort(key=lambda x: (-x[0], x[1]))
        best: pd.DataFrame | None = None
        nth: dict[str, float] = {}
        read = skipped = 0
        none = highest = float("-inf")  # the highest N-th score so far; no maximum from there on can be skipped
        for top, k, only in parts:
            if only is not None:
                held = [only]
            elif top < highest:
                held = source.read_row_group(k, columns=["_group"]).column(0).unique().to_pylist()
            else:
                held = None
            if held is not None and all(top < nth.get(g, none) for g in held):
                skipped += 1
                continue
            read += 1
            part = source.read_row_group(k, columns=columns).to_pandas()
            touched = part["_group"].unique()
            if best is not None:
                again = best["_group"].isin(touched)
                part = pd.concat([best[again], part], ignore_index=True)
                best = best[~again]
            part = part.sort_values(["_group", "_first", "_second", "_item"], ascending=[True, False, False, True], na_position="last", kind="stable")
            place = part.groupby("_group", sort=False).cumcount()
            part, place = part[place < n], place[place < n]
            full = part[place == n - 1]
            nth.update(zip(full["_group"], full["_bound"]))
            highest = max(highest, full["_bound"].max()) if len(full) else highest
            best = part if best is None or best.empty else pd.concat([best, part], ignore_index=True)
    return (best if best is not None else pd.DataFrame(columns=columns)), read, skipped


def steering(rows: DataFrame, n: int, files: int) -> tuple[DataFrame, int]:
    """For each group over how many files it is spread and in which class of N-th scores it falls; and all rows' number.

    The scores at which items are counted are quantiles of the whole table. The class of a group is the number of these
    scores that at least ``n`` of its items reach. The result only steers the layout; no row is left out by it.
    """
    spread = [k / STEPS for k in range(1, STEPS)]
    told = rows.agg(F.count("*").alias("n"), F.percentile_approx("_first", spread, 1000).alias("q")).first()
    cuts = sorted({x for x in told["q"] or [] if x is not None})
    share = max(1000, told["n"] // (4 * files))
    reach = [(F.count_if(F.col("_first") >= c) >= n).cast("int") for c in cuts]
    level = sum(reach, F.lit(0)) if reach else F.lit(0)
    parts = F.least(F.lit(files), F.ceil(F.count("*") / share)).cast("int")
    return rows.groupBy("_group").agg(parts.alias("_parts"), level.alias("_class")), told["n"]


def cluster(spark: SparkSession, rows: DataFrame, n: int, whole: bool) -> list[str]:
    """Writes ``rows`` (_group, _item, _first, _second) clustered into the shared folder; returns the files' URIs."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told, total = steering(rows, n, files)
    files = max(files, -(-total // ROWS_PER_FILE))
    per_group = max(ROW_GROUP_ROWS[0], min(ROW_GROUP_ROWS[1], total // files // 16))
    salt = F.pmod(F.xxhash64("_item", "_first", "_second"), F.col("_parts").cast("long")).cast("int")
    clustered = (
        rows.join(told, "_group")
        .withColumn("_salt", salt)
        .repartition(files, "_group", "_salt")
        .withColumn("_bound", score_bound(F.col("_first"), F.col("_second"), whole))
        # Spread groups each by themselves, the others by class.
        .sortWithinPartitions(F.desc("_parts"), F.when(F.col("_parts") > 1, F.col("_group")), F.desc("_class"), F.desc("_bound"))
        .select("_group", "_bound", "_first", "_second", "_item")
    )
    path = scratch_path(spark, "clustered")
    clustered.write.option("parquet.block.row.count.limit", str(per_group)).parquet(path)
    return [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]


_SCANNED = "_group string, _first double, _second double, _item string, _uri string, _read int, _skipped int"


def scanned(spark: SparkSession, uris: list[str], n: int) -> DataFrame:
    """The survivors of every file and, in a row without item for each file, how many row groups were read and skipped."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                found, read, skipped = scan_clustered(uri, n)
                yield found[["_group", "_first", "_second", "_item"]].astype({"_first": "float64", "_second": "float64"}).assign(_uri=None, _read=None, _skipped=None)
                yield pd.DataFrame({"_group": [None], "_first": [None], "_second": [None], "_item": [None], "_uri": [uri], "_read": [read], "_skipped": [skipped]})

    if not uris:
        return spark.createDataFrame([], _SCANNED)
    return spark.createDataFrame([(u,) for u in uris], "uri string").repartition(len(uris)).mapInPandas(scan, _SCANNED)


def clustered_items(items: DataFrame, groups: DataFrame, group: str, item: str, first: str, second: str, n: int) -> list[str]:
    rows = items.select(F.col(group).alias("_group"), F.col(item).alias("_item"), plain_number(F.col(first)).alias("_first"), plain_number(F.col(second)).alias("_second")).filter("_group is not null")
    wanted = groups.select(F.col(group).alias("_group")).filter("_group is not null").distinct()
    stored = written(rows.join(wanted, "_group", "left_semi"), "wanted")  # counted, then clustered
    return cluster(items.sparkSession, stored, n, isinstance(items.schema[first].dataType, IntegralType))


def top_n(items: DataFrame, groups: DataFrame, group: str, item: str, first: str, second: str, n: int) -> DataFrame:
    """The best ``n`` rows of ``items`` for each distinct ``group`` value of ``groups``.

    Result: group, place (1..n), item, first, second. Order: ``first`` descending, ``second`` descending, ``item``
    ascending by code points; null and NaN rank after every number. Rows with a null group are no one's; equal rows each
    take a place of their own. Groups without items give no row. ``item`` must be a string; scores are compared as
    doubles. The files are written by jobs that run when this is called.
    """
    uris = clustered_items(items, groups, group, item, first, second, n)
    clean = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)  # noqa: E731  pandas turns nulls into NaN
    survivors = scanned(items.sparkSession, uris, n).filter("_uri is null").select("_group", "_item", clean("_first"), clean("_second"))
    order = Window.partitionBy("_group").orderBy(F.col("_first").desc_nulls_last(), F.col("_second").desc_nulls_last(), F.col("_item").asc_nulls_last())
    placed = survivors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
    return placed.select(F.col("_group").alias(group), F.col("place").cast("int").alias("place"), F.col("_item").alias(item), F.col("_first").alias(first), F.col("_second").alias(second))


def skipping(items: DataFrame, groups: DataFrame, group: str, item: str, first: str, second: str, n: int) -> DataFrame:
    """How many row groups ``top_n`` reads and skips: files, row_groups_read, row_groups_skipped."""
    figures = scanned(items.sparkSession, clustered_items(items, groups, group, item, first, second, n), n).filter("_uri is not null")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return figures.agg(F.count("*").alias("files"), total("_read").alias("row_groups_read"), total("_skipped").alias("row_groups_skipped"))


_REGION = ("image_id", "region_id", "grounder_support", "median_pairwise_iou")


def latest_regions(grounded: DataFrame) -> DataFrame:
    return latest_rows(grounded, "region_id", "recorded_at", "ingested_at", "grounder_support", "median_pairwise_iou", "image_id")


def best_regions(grounded: DataFrame, chosen: DataFrame, n: int = 5) -> DataFrame:
    """For every image of ``chosen`` its best ``n`` regions, each region judged by its latest row only."""
    return top_n(latest_regions(grounded), chosen, *_REGION, n)


def region_skipping(grounded: DataFrame, chosen: DataFrame, n: int = 5) -> DataFrame:
    return skipping(latest_regions(grounded), chosen, *_REGION, n)
