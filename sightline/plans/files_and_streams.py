"""Queries of sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators import relational as R
from sightline.plans import fixtures as X
from sightline.session import scratch_path
from sightline.sources import files, sinks, table
from sightline.streaming import replay


def records_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Proposals written as record lines and read again with a schema."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "category", "attributes", "caption_supported").distinct()
    path = scratch_path(spark, "records")
    sinks.write_records(e, path)
    back = files.read_records(spark, path, e.schema)
    return back.select("image_id", "entity_id", "rank", "category", F.array_join("attributes", ",").alias("attributes"), "caption_supported")


def annotation_scan(spark: SparkSession, d: str) -> DataFrame:
    """Captions written as annotation files by URL and read back by their key."""
    m = table(spark, d, "manifest", "image_id", "image_path", "caption", "batch_no", "recorded_at", "ingested_at")
    one = R.first_per_key(m.withColumn("k", F.lower(F.trim("image_id"))), ["k"], [F.col("batch_no"), F.col("recorded_at"), F.col("ingested_at")])
    path = scratch_path(spark, "annotations")
    sinks.write_records(one.select(F.concat(F.lit("https://host.example/data/"), "image_path").alias("url"), F.col("image_path").alias("file_name"), "caption"), path)
    return files.read_annotations(spark, [path]).select("image_id", F.length("caption").cast("bigint").alias("chars"))


def row_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return files.with_ordinals(spark, f"{d}/documents.parquet", "doc_id", "lang")


def parquet_profile(spark: SparkSession, d: str) -> DataFrame:
    return files.parquet_profile(spark, d)


def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return files.seeded_sample(X.sizes(spark, d), "image_id", 0, 100, 42).select("image_id", "ordinal")


def file_hashes(spark: SparkSession, d: str) -> DataFrame:
    return files.file_hashes(spark, d)


def mask_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes around the marked pixels of small masks."""
    p = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    pixels = p.select(F.col("l_orderkey").alias("image_id"), (F.col("l_partkey") % 64).alias("x"), (F.col("l_suppkey") % 48).alias("y"), F.when(F.col("l_quantity") > 10, 1).otherwise(0).alias("value"))
    return files.mask_boxes(pixels, ["image_id"])


def snapshot_restore(spark: SparkSession, d: str) -> DataFrame:
    """A table after two incremental commits, restored from them."""
    e = X.expressions(spark, d).select("image_id", "det_no", "expression").withColumn("signature", R.signature_of("expression"))
    first = e.filter("det_no % 3 <> 2")
    second = e.filter("det_no % 5 <> 4").withColumn("expression", F.when(F.col("det_no") == 1, F.upper("expression")).otherwise(F.col("expression"))).withColumn("signature", R.signature_of("expression"))
    path = scratch_path(spark, "snapshots")
    keys = ["image_id", "det_no"]
    sinks.commit_snapshot(spark, first, None, keys, "signature", path, 1)
    sinks.commit_snapshot(spark, second, first, keys, "signature", path, 2)
    return sinks.restore_snapshot(spark, path, 2, keys).select("image_id", "det_no", "expression")


def _log(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    e = F.col("event_id")
    return replay.read_log(spark, d, "events", schema).select(e.alias("request_id"), F.col("user_id").alias("image_id"), F.col("event_type").alias("stage"), F.col("ts").cast("timestamp").alias("ts"), (e % 7 != 0).alias("committed"))


SPAN = "31 days"  # the log's events come in any order within a month, so nothing older can still come


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Log rows per stage and hour, from the stream; each window's last count."""
    hours = replay.windowed_counts(_log(spark, d), "ts", "stage", "1 hour", SPAN)
    return replay.drain(hours, "windows", ["window_start", "stage"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_once(spark: SparkSession, d: str) -> DataFrame:
    """Each request once, from the stream."""
    return replay.drain(replay.once_per_key(_log(spark, d), ["request_id"], "ts", SPAN), "once").select("request_id", "stage")


def stateful_replay(spark: SparkSession, d: str) -> DataFrame:
    """The state of every image after the whole log has passed."""
    return replay.drain(replay.progress_states(_log(spark, d)), "states", ["image_id"]).select("image_id", "committed", "last_request", "step")


QUERIES = [records_round_trip, annotation_scan, row_ordinals, parquet_profile, seeded_sample, file_hashes, mask_boxes, snapshot_restore, stream_windows, stream_once, stateful_replay]

SQL = {
    "records_round_trip": "SELECT DISTINCT image_id, entity_id, rank, category, array_to_string(attributes, ',') AS attributes, caption_supported FROM entities",
    "annotation_scan": r"""WITH one AS (SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY lower(trim(image_id, ' ')) ORDER BY batch_no NULLS FIRST, recorded_at NULLS FIRST, ingested_at NULLS FIRST) = 1)
SELECT regexp_extract(image_path, '([^/]*?)(\.[^./]*)?$', 1) AS image_id, length(caption) AS chars FROM one WHERE trim(caption, ' ') <> ''""",
    "row_ordinals": "SELECT doc_id, lang, row_number() OVER () - 1 AS row_ordinal FROM documents",
    "mask_boxes": """SELECT l_orderkey AS image_id, CAST(min(l_partkey % 64) AS DOUBLE) AS x1, CAST(min(l_suppkey % 48) AS DOUBLE) AS y1, CAST(max(l_partkey % 64) + 1 AS DOUBLE) AS x2,
  CAST(max(l_suppkey % 48) + 1 AS DOUBLE) AS y2 FROM lineitem WHERE l_quantity > 10 GROUP BY 1""",
    "snapshot_restore": X.with_views("expr") + " SELECT image_id, det_no, CASE WHEN det_no = 1 THEN upper(expression) ELSE expression END AS expression FROM expr WHERE det_no % 5 <> 4",
    "stream_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type AS stage, count(*) AS rows FROM events GROUP BY 1, 2",
    "stream_once": "SELECT DISTINCT event_id AS request_id, event_type AS stage FROM events",
    "stateful_replay": "SELECT user_id AS image_id, count(*) FILTER (WHERE event_id % 7 <> 0) AS committed, max(event_id) AS last_request, count(*) AS step FROM events GROUP BY 1",
}
