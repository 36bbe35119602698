"""Queries of grounding calls, audits of what they found, and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions import geometry as G
from sightline.functions import text as T
from sightline.operators import consensus as C
from sightline.operators import delivery, folds, inference
from sightline.operators import relational as R
from sightline.plans import fixtures as X
from sightline.plans.consensus import KEYS, _fold_sql
from sightline.session import scratch_path
from sightline.sources import table

_CORNERS = ("x1", "y1", "x2", "y2")


def _shifting_model(batch):
    """A stand-in for a detector: up to three boxes, each further to the right; some requests fail."""
    from sightline.operators.inference import InvalidAnswer, OverContext

    out = []
    for n, x1, y1, x2, y2 in zip(batch["det_no"], batch["x1"], batch["y1"], batch["x2"], batch["y2"]):
        boxes = [{"x1": x1 + 300.0 * j, "y1": y1, "x2": x2 + 300.0 * j, "y2": y2, "score": None if j else 0.5} for j in range(n % 4)]
        out.append(InvalidAnswer("no list") if n % 11 == 0 else OverContext("too long") if n % 13 == 0 else {"boxes": boxes})
    return out


def _grounded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    det = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    requests = det.select((F.col("image_id") * 100 + F.col("det_no")).alias("request_id"), "det_no", *_CORNERS, "width", "height")
    return inference.ground(requests, ["det_no", *_CORNERS], _shifting_model)


def grounding_calls(spark: SparkSession, d: str) -> DataFrame:
    """The detections of every request, clipped to its image and numbered."""
    return _grounded(spark, d)[0]


def grounding_markers(spark: SparkSession, d: str) -> DataFrame:
    return _grounded(spark, d)[1]


def geometry_audit(spark: SparkSession, d: str) -> DataFrame:
    """Category detections against all that the locator found for their image and category."""
    det = X.detections(spark, d)
    a = C.geometry_audit(det.filter("query_type = 'category'"), det.filter("query_type = 'locator'"), KEYS, "det_no")
    return a.withColumn("reground_iou", F.round("reground_iou", 9))


def context_views(spark: SparkSession, d: str) -> DataFrame:
    """Views around every detection, without the full image and repeats; two where its number is even, else three."""
    det = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    b, w, h = G.box(), F.col("width"), F.col("height")
    full = G.Box(F.lit(0.0), F.lit(0.0), w.cast("double"), h.cast("double"))
    views = [G.padded(b, w, h, 0.2), full, G.padded(b, w, h, 0.2), G.expand(b, w, h, 3.0, 0.15), G.expand(b, w, h, 2.0, 0.0)]
    listed = F.array(*[F.struct(F.lit(k).alias("view_no"), *[v.alias(n) for n, v in zip(_CORNERS, view)]) for k, view in enumerate(views, 1)])
    rows = det.select("image_id", "det_no", "width", "height", F.inline(listed))
    kept = folds.context_views(rows, ["image_id", "det_no"], "view_no", F.col("det_no") % 2 == 0)
    return kept.select("image_id", "det_no", "view_no", "place")


def detection_insert(spark: SparkSession, d: str) -> DataFrame:
    """Detections found in a crop, in the image's coordinates, that are valid and not there yet; every sixth is there."""
    window = G.Box(*[F.lit(v) for v in (100.0, 50.0, 700.0, 650.0)])
    moved = G.crop_to_original(G.box(), window, F.lit(100.0), F.lit(100.0))
    det = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    found = det.select("image_id", "category", "grounder", "det_no", "width", "height", *[v.alias(n) for n, v in zip(_CORNERS, moved)])
    new = delivery.inserted(found, found.filter("det_no % 6 = 0"), ["image_id", "category", "grounder"], ["det_no"])
    return new.select("image_id", "category", "grounder", "det_no")


def delivery_fanout(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table of a delivery per image, as read back: regions with their last draft, searches, rejections."""
    g = table(spark, d, "grounded_entities", "region_id", "image_id", "category", "size_pass", "size_reject_reason", "recorded_at", "ingested_at")
    regions = R.first_per_key(g, ["region_id"], [F.desc("recorded_at"), F.desc("ingested_at")])
    x = table(spark, d, "expression_drafts", "expression_id", "region_id", "expression", "revision", "ingested_at")
    drafts = R.first_per_key(x, ["region_id"], [F.desc("revision"), F.col("ingested_at"), F.col("expression_id"), F.col("expression")]).select("region_id", F.col("expression").alias("phrase"))
    passed = regions.filter("size_pass").join(drafts, "region_id", "left").select("image_id", "region_id", "category", "phrase")
    is_the = F.startswith(F.lower("phrase"), F.lit("the "))
    objects = passed.withColumn("status", F.when(is_the, "verified").otherwise("unresolved")).withColumn("reason", F.when(F.col("phrase").isNotNull() & ~is_the, "phrase_form"))
    e = table(spark, d, "entities", "image_id", "entity_id", "category").distinct()
    there = table(spark, d, "grounded_entities", "image_id", "entity_id").distinct().withColumn("_there", F.lit(True))
    searches = e.join(there, ["image_id", "entity_id"], "left").groupBy("image_id", T.fold(F.col("category")).alias("category")).agg(F.count_if(F.col("_there").isNull()).alias("open"))
    candidates = regions.select("image_id", "region_id", F.when(F.col("size_pass"), "accepted").otherwise("rejected").alias("status"), F.col("size_reject_reason").alias("reason"))
    tables = delivery.fan_out(objects, searches, candidates, table(spark, d, "route_b", "image_id"))
    path = scratch_path(spark, "delivery")
    delivery.write_delivery(tables, path)
    back = delivery.read_delivery(spark, tables, path)
    told = {"objects": "status", "verified": "status", "unresolved": "reason", "search_audit": "stop_reason", "rejected": "reason"}
    out = back["counts_by_image"].select(F.lit("counts_by_image").alias("output"), "image_id", F.concat_ws("/", "object_count", "unresolved_count").alias("told"), F.col("final_count").alias("rows"))
    for name, column in told.items():
        out = out.unionByName(back[name].groupBy("image_id", F.col(column).alias("told")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("output"), "image_id", "told", "rows"))
    return out


QUERIES = [grounding_calls, grounding_markers, geometry_audit, context_views, detection_insert, delivery_fanout]

_ASKED = """, c AS (SELECT d.image_id * 100 + det_no AS request_id, det_no, width, height, j, x1 + 300.0 * j AS x1, y1, x2 + 300.0 * j AS x2, y2 FROM
    (SELECT *, unnest(range(det_no % 4)) AS j FROM det WHERE det_no % 11 <> 0 AND det_no % 13 <> 0) d JOIN size s ON s.image_id = d.image_id),
  k AS (SELECT request_id, j, least(x1, width) AS x1, least(y1, height) AS y1, least(x2, width) AS x2, least(y2, height) AS y2 FROM c),
  v AS (SELECT * FROM k WHERE x2 - x1 >= 1 AND y2 - y1 >= 1)"""


def _padded(lo: str, hi: str, whole: str) -> tuple[str, str]:
    return f"floor(greatest(0.0, least({lo} - ({hi} - {lo}) * 0.2, {whole})))", f"ceil(greatest(0.0, least({hi} + ({hi} - {lo}) * 0.2, {whole})))"


def _expanded(lo: str, hi: str, whole: str, scale: float, least: float) -> tuple[str, str]:
    size = f"least(CAST({whole} AS DOUBLE), greatest(({hi} - {lo}) * {scale}, {whole} * {least}))"
    start = f"greatest(0.0, least({whole} - {size}, ({lo} + {hi}) / 2 - {size} / 2))"
    return f"floor({start})", f"ceil({start} + {size})"


def _view(n: int, x: tuple[str, str], y: tuple[str, str]) -> str:
    return f"SELECT d.image_id, det_no, width, height, {n} AS view_no, CAST({x[0]} AS DOUBLE) AS x1, CAST({y[0]} AS DOUBLE) AS y1, CAST({x[1]} AS DOUBLE) AS x2, CAST({y[1]} AS DOUBLE) AS y2 FROM det d JOIN size s ON s.image_id = d.image_id"


_PAD = _padded("x1", "x2", "width"), _padded("y1", "y2", "height")
_VIEWS = " UNION ALL ".join(
    [_view(1, *_PAD), _view(2, ("0", "width"), ("0", "height")), _view(3, *_PAD)]
    + [_view(n, _expanded("x1", "x2", "width", s, m), _expanded("y1", "y2", "height", s, m)) for n, s, m in ((4, 3.0, 0.15), (5, 2.0, 0.0))]
)

SQL = {
    "grounding_calls": X.with_views("det", "size") + _ASKED + """
SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY j) - 1 AS INT) AS detection_index, x1, y1, x2, y2, CASE WHEN j = 0 THEN 0.5 END AS score FROM v""",
    "grounding_markers": X.with_views("det", "size") + _ASKED + """
SELECT d.image_id * 100 + det_no AS request_id, CAST((SELECT count(*) FROM v WHERE v.request_id = d.image_id * 100 + det_no) AS INT) AS detections,
  CASE WHEN det_no % 11 = 0 THEN 3 ELSE 1 END AS attempts, CASE WHEN det_no % 11 = 0 THEN 'no list' WHEN det_no % 13 = 0 THEN 'too long' END AS error FROM det d JOIN size s ON s.image_id = d.image_id""",
    "geometry_audit": X.with_views("det") + f""", n AS (SELECT image_id, category, count(*) AS n FROM det WHERE query_type = 'locator' GROUP BY 1, 2),
  o AS (SELECT t.image_id, t.category, t.det_no, max(coalesce({X.iou('b', 't')}, 0.0)) AS o, min({X.size_ratio('b', 't')}) AS r FROM det t LEFT JOIN det b
    ON b.image_id = t.image_id AND b.category = t.category AND b.query_type = 'locator' WHERE t.query_type = 'category' GROUP BY 1, 2, 3),
  j AS (SELECT o.image_id, o.category, det_no, coalesce(n, 0) AS box_count, o, coalesce(n, 0) = 1 AND o >= 0.5 AND r <= 1.25 AS passed FROM o LEFT JOIN n ON n.image_id = o.image_id AND n.category = o.category)
SELECT image_id, category, det_no, box_count, round(o, 9) AS reground_iou, passed, CASE WHEN passed THEN NULL WHEN box_count = 0 THEN 'no_valid_locator_box' ELSE 'locator_target_disagreement' END AS reason FROM j""",
    "context_views": X.with_views("det", "size") + f""", views AS ({_VIEWS}),
  partial AS (SELECT * FROM views WHERE NOT (x1 = 0 AND y1 = 0 AND x2 = width AND y2 = height)),
  {_fold_sql('partial', 'image_id, det_no', 'view_no', X.iou('@a', '@b') + ' > 0.97')}
SELECT image_id, det_no, d.rk AS view_no, CAST(row_number() OVER (PARTITION BY image_id, det_no ORDER BY d.rk) AS INT) AS place FROM kept QUALIFY place <= CASE WHEN det_no % 2 = 0 THEN 2 ELSE 3 END""",
    "detection_insert": X.with_views("det", "size") + """, m AS (SELECT d.image_id, category, grounder, det_no, width, height, 100 + x1 * 6 AS x1, 50 + y1 * 6 AS y1, 100 + x2 * 6 AS x2, 50 + y2 * 6 AS y2
    FROM det d JOIN size s ON s.image_id = d.image_id)
SELECT image_id, category, grounder, min(det_no) AS det_no FROM m a WHERE x2 <= width AND y2 <= height AND NOT EXISTS (SELECT 1 FROM m b WHERE b.det_no % 6 = 0 AND b.image_id = a.image_id
  AND b.category = a.category AND b.grounder = a.grounder AND b.x1 = a.x1 AND b.y1 = a.y1 AND b.x2 = a.x2 AND b.y2 = a.y2) GROUP BY image_id, category, grounder, x1, y1, x2, y2""",
    "delivery_fanout": """WITH g AS (SELECT * FROM grounded_entities QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY recorded_at DESC NULLS LAST, ingested_at DESC NULLS LAST) = 1),
  x AS (SELECT region_id, expression AS phrase FROM expression_drafts
    QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY revision DESC NULLS LAST, ingested_at NULLS FIRST, expression_id NULLS FIRST, expression NULLS FIRST) = 1),
  o AS (SELECT image_id, phrase, CASE WHEN starts_with(lower(phrase), 'the ') THEN 'verified' ELSE 'unresolved' END AS status FROM g LEFT JOIN x ON x.region_id = g.region_id WHERE size_pass),
  e AS (SELECT DISTINCT image_id, entity_id, category FROM entities),
  s AS (SELECT image_id, lower(trim(coalesce(category, ''), ' ')) AS category, count(*) FILTER (WHERE NOT EXISTS
    (SELECT 1 FROM grounded_entities q WHERE q.image_id = e.image_id AND q.entity_id = e.entity_id)) AS open FROM e GROUP BY 1, 2)
SELECT 'counts_by_image' AS output, r.image_id, coalesce(n, 0) || '/' || coalesce(u, 0) AS told, coalesce(v, 0) AS rows FROM (SELECT DISTINCT image_id FROM route_b) r LEFT JOIN
  (SELECT image_id, count(*) AS n, count(*) FILTER (WHERE status = 'verified') AS v, count(*) FILTER (WHERE status <> 'verified') AS u FROM o GROUP BY 1) c ON c.image_id = r.image_id
UNION ALL SELECT 'objects', image_id, status, count(*) FROM o GROUP BY 2, 3
UNION ALL SELECT 'verified', image_id, status, count(*) FROM o WHERE status = 'verified' GROUP BY 2, 3
UNION ALL SELECT 'unresolved', image_id, CASE WHEN phrase IS NULL THEN 'no_phrase_before_search_drain_completed' ELSE 'phrase_form' END, count(*) FROM o WHERE status <> 'verified' GROUP BY 2, 3
UNION ALL SELECT 'search_audit', image_id, CASE WHEN open > 0 THEN 'budget_exhausted' ELSE 'no_pending_evidence' END, count(*) FROM s GROUP BY 2, 3
UNION ALL SELECT 'rejected', image_id, coalesce(size_reject_reason, ''), count(*) FROM g WHERE NOT coalesce(size_pass, FALSE) GROUP BY 2, 3""",
}
