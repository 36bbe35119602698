"""Views that give the base tables the shapes of detections, image sizes, phrases, logs, hints and comparisons.

Each view exists twice: as a DataFrame and as the text of a common table expression, from which the SQL of the
registered queries is put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.sources import table

DETECTION_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]


def detections(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem", "l_orderkey", *DETECTION_ORDER).withColumnRenamed("l_orderkey", "image_id")
    # Renamed before it is partitioned: what follows by image and further keys then needs no further exchange.
    no = F.row_number().over(Window.partitionBy("image_id").orderBy(*DETECTION_ORDER))
    left, top = F.col("l_suppkey") * 7 % 40, F.col("l_suppkey") * 3 % 40
    part = F.col("l_partkey") % 3
    return line.select(
        "image_id",
        no.cast("int").alias("det_no"),
        F.when(part == 0, "sam31").when(part == 1, "rex_omni").otherwise("groundingdino").alias("grounder"),
        F.when(F.col("l_linenumber") % 2 == 1, "category").otherwise("locator").alias("query_type"),
        F.col("l_returnflag").alias("category"),
        left.cast("double").alias("x1"),
        top.cast("double").alias("y1"),
        (left + 20 + F.col("l_quantity")).cast("double").alias("x2"),
        (top + 20 + F.col("l_quantity")).cast("double").alias("y2"),
        F.when(part != 1, 1 - F.col("l_discount")).alias("score"),
    )


def sizes(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, d, "orders", "o_orderkey").select(key.alias("image_id"), (400 + key % 4 * 100).cast("int").alias("width"), (300 + key % 3 * 100).cast("int").alias("height"))


def expressions(spark: SparkSession, d: str) -> DataFrame:
    no = F.col("det_no")
    text = F.when(no % 4 == 0, F.concat(F.lit("  The "), "category", F.lit(" item "))).otherwise(F.concat(F.lit("the "), "category", F.lit(" item "), (no % 4).cast("string")))
    return detections(spark, d).select("image_id", "det_no", F.col("category").alias("category_query"), "x1", "y1", "x2", "y2", (no % 3).cast("int").alias("revision"), text.alias("expression"))


def stage_log(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, d, "events", "event_id", "user_id", "event_type", "ts", "value").select(
        e.alias("request_id"), F.col("user_id").alias("image_id"), F.col("event_type").alias("stage"), "ts",
        F.floor("value").cast("bigint").alias("detections"), (e % 7 != 0).alias("committed"), (e % 11 == 0).alias("model_output_invalid"),
    )


def hints(spark: SparkSession, d: str) -> DataFrame:
    log = stage_log(spark, d)
    no = F.row_number().over(Window.partitionBy("image_id", "stage").orderBy("ts", "request_id"))
    r = F.col("request_id") % 3
    return log.select("image_id", F.col("stage").alias("category"), no.cast("int").alias("hint_no"), F.when(r == 0, "done").when(r == 1, "pending").otherwise("running").alias("status"))


def comparisons(spark: SparkSession, d: str) -> DataFrame:
    """Every detection of an image against the four numbered before and the four after it."""
    det = detections(spark, d).select("image_id", "det_no")
    peers = F.array(*[F.col("det_no") + k for k in range(-4, 5) if k])
    asked = det.select("image_id", F.col("det_no").alias("object_no"), F.explode(peers).alias("peer_no"))
    n = (F.col("object_no") + F.col("peer_no")) % 5
    return asked.join(det.withColumnRenamed("det_no", "peer_no"), ["image_id", "peer_no"]).select("image_id", "object_no", "peer_no", F.when(n == 0, True).when(n != 1, False).alias("also_matches"))


_SQL = {
    "det": """SELECT l_orderkey AS image_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS INT) AS det_no,
  CASE l_partkey % 3 WHEN 0 THEN 'sam31' WHEN 1 THEN 'rex_omni' ELSE 'groundingdino' END AS grounder,
  CASE WHEN l_linenumber % 2 = 1 THEN 'category' ELSE 'locator' END AS query_type, l_returnflag AS category,
  CAST((l_suppkey * 7) % 40 AS DOUBLE) AS x1, CAST((l_suppkey * 3) % 40 AS DOUBLE) AS y1,
  CAST((l_suppkey * 7) % 40 + 20 + l_quantity AS DOUBLE) AS x2, CAST((l_suppkey * 3) % 40 + 20 + l_quantity AS DOUBLE) AS y2,
  CASE WHEN l_partkey % 3 = 1 THEN CAST(NULL AS DOUBLE) ELSE 1 - l_discount END AS score
FROM lineitem""",
    "size": """SELECT o_orderkey AS image_id, CAST(400 + (o_orderkey % 4) * 100 AS INT) AS width,
  CAST(300 + (o_orderkey % 3) * 100 AS INT) AS height FROM orders""",
    "expr": """SELECT image_id, det_no, category AS category_query, x1, y1, x2, y2, CAST(det_no % 3 AS INT) AS revision,
  CASE WHEN det_no % 4 = 0 THEN '  The ' || category || ' item '
       ELSE 'the ' || category || ' item ' || CAST(det_no % 4 AS VARCHAR) END AS expression
FROM det""",
    "log": """SELECT event_id AS request_id, user_id AS image_id, event_type AS stage, ts,
  CAST(floor(value) AS BIGINT) AS detections, event_id % 7 <> 0 AS committed, event_id % 11 = 0 AS model_output_invalid
FROM events""",
    "hint": """SELECT image_id, stage AS category,
  CAST(row_number() OVER (PARTITION BY image_id, stage ORDER BY ts, request_id) AS INT) AS hint_no,
  CASE request_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'pending' ELSE 'running' END AS status
FROM log""",
    "comp": """SELECT a.image_id, a.det_no AS object_no, b.det_no AS peer_no,
  CASE (a.det_no + b.det_no) % 5 WHEN 0 THEN TRUE WHEN 1 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS also_matches
FROM det a JOIN det b ON a.image_id = b.image_id AND abs(a.det_no - b.det_no) BETWEEN 1 AND 4""",
}
_NEEDS = {"expr": ["det"], "hint": ["log"], "comp": ["det"]}


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause of the named views and those they need; more expressions may follow after a comma."""
    order: list[str] = []
    for n in names:
        for x in [*_NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{n} AS (\n{_SQL[n]}\n)" for n in order)


# SQL texts of the box measures, for aliases with columns x1 .. y2.


def area(a: str) -> str:
    return f"(greatest(0.0, {a}.x2 - {a}.x1) * greatest(0.0, {a}.y2 - {a}.y1))"


def shared(a: str, b: str) -> str:
    return f"(greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"


def iou(a: str, b: str) -> str:
    union = f"({area(a)} + {area(b)} - {shared(a, b)})"
    return f"(CASE WHEN {union} > 0 THEN {shared(a, b)} / {union} ELSE 0.0 END)"


def containment(a: str, b: str) -> str:
    return f"(CASE WHEN {area(a)} > 0 THEN {shared(a, b)} / {area(a)} ELSE 0.0 END)"


def size_ratio(a: str, b: str) -> str:
    return f"(greatest({area(a)}, {area(b)}) / greatest(least({area(a)}, {area(b)}), 1e-9))"


def matched(a: str, b: str) -> str:
    inside = f"CASE WHEN {area(a)} <= {area(b)} THEN {containment(a, b)} ELSE {containment(b, a)} END"
    return f"({iou(a, b)} >= 0.5 OR (least({area(a)}, {area(b)}) > 0 AND {inside} >= 0.8 AND {size_ratio(a, b)} <= 3.0))"
