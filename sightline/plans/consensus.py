"""Queries of detector agreement: thinning, matching, components, instances, suppression, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import box, size_columns
from sightline.operators import consensus as C
from sightline.operators import folds, spatial
from sightline.plans import fixtures as X

KEYS = ["image_id", "category"]


def nms_within_detector(spark: SparkSession, d: str) -> DataFrame:
    kept = C.thinned(X.detections(spark, d), KEYS, "det_no")
    return kept.select(*KEYS, "grounder", "det_no")


def pair_match(spark: SparkSession, d: str) -> DataFrame:
    return C.matched_pairs(X.detections(spark, d), KEYS, "det_no")


def components(spark: SparkSession, d: str) -> DataFrame:
    return C.clustered(X.detections(spark, d), KEYS, "det_no").select(*KEYS, "det_no", "cluster")


def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = C.cluster_statistics(C.clustered(X.detections(spark, d), KEYS, "det_no"), KEYS, "det_no")
    return stats.select(
        *KEYS, "cluster", F.array_join("detectors", ",").alias("detectors"), F.col("support").cast("bigint").alias("support"), F.col("matched_pairs").cast("bigint").alias("matched_pairs"),
        F.round("median_iou", 6).alias("median_iou"), F.round("mean_score", 6).alias("mean_score"), F.col("members").cast("bigint").alias("members"),
    )


def representative_box(spark: SparkSession, d: str) -> DataFrame:
    return C.representatives(C.clustered(X.detections(spark, d), KEYS, "det_no"), KEYS, "det_no").select(*KEYS, "cluster", "x1", "y1", "x2", "y2", "representative", "method")


def consensus_instances(spark: SparkSession, d: str) -> DataFrame:
    found = C.instances(X.detections(spark, d), X.sizes(spark, d), KEYS, "det_no")
    return found.select(
        *KEYS, F.col("instance_no").cast("int").alias("instance_no"), "x1", "y1", "x2", "y2", F.col("support").cast("bigint").alias("support"), F.round("median_iou", 6).alias("median_iou"),
        F.round("mean_score", 6).alias("mean_score"), "size_band", "size_pass",
    )


def consensus_rejections(spark: SparkSession, d: str) -> DataFrame:
    """Keys without an instance, with the number of detections of each detector as text."""
    det = X.detections(spark, d)
    found = C.instances(det, X.sizes(spark, d), KEYS, "det_no", sized=False)
    r = C.rejections(det, found, KEYS)
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return r.select(*KEYS, listed.alias("detector_counts"), "reject_reason")


def reground_audit(spark: SparkSession, d: str) -> DataFrame:
    """Every detection as a target of its own, the instances of its category as what a phrase led to."""
    det = X.detections(spark, d)
    targets = det.select(*KEYS, F.col("det_no").alias("target_no"), "x1", "y1", "x2", "y2")
    found = C.instances(det, X.sizes(spark, d), KEYS, "det_no", sized=False).select(*KEYS, "x1", "y1", "x2", "y2", "support", "median_iou")
    a = C.regrounding_audit(targets, found, KEYS, target="target_no")
    return a.select(*KEYS, "target_no", F.col("cluster_count").cast("bigint").alias("cluster_count"), F.col("target_count").cast("bigint").alias("target_count"), F.col("support").cast("bigint").alias("support"), F.round("reground_iou", 9).alias("reground_iou"), "reason", "passed")


def repair_top2(spark: SparkSession, d: str) -> DataFrame:
    """For every detection the smaller boxes of its image and category that could stand in for it."""
    det = X.detections(spark, d)
    candidates = det.select(*KEYS, F.col("det_no").alias("target_no"), "x1", "y1", "x2", "y2").join(X.sizes(spark, d), "image_id")
    r = C.repair_options(det, candidates, KEYS, "det_no", target="target_no")
    return r.select(*KEYS, "target_no", "det_no", F.col("support").cast("bigint").alias("support"), F.col("place").cast("int").alias("place"))


def size_assess(spark: SparkSession, d: str) -> DataFrame:
    j = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    columns = size_columns(box(), F.col("width"), F.col("height"), preferred=(0.01, 0.02), most=0.03)
    return j.withColumns(columns).select("image_id", "det_no", "bbox_short_side_px", "bbox_area_ratio", "size_band", "size_pass", "size_reject_reason")


def duplicate_suspects(spark: SparkSession, d: str) -> DataFrame:
    e = X.expressions(spark, d).select("image_id", "det_no", F.lit("whole_object").alias("scope"), F.col("category_query").alias("category"), F.when(F.col("det_no") % 2 == 0, F.col("expression")).alias("phrase"), "x1", "y1", "x2", "y2")
    return spatial.duplicate_suspects(e, "image_id", "det_no")


def _ranked_final(spark: SparkSession, d: str) -> DataFrame:
    e = X.expressions(spark, d)
    order = Window.partitionBy("image_id").orderBy(F.desc((F.col("x2") - F.col("x1"))), F.asc("revision"), "det_no")
    return e.select("image_id", "det_no", F.lower(F.trim("expression")).alias("phrase"), "x1", "y1", "x2", "y2", F.row_number().over(order).alias("quality"))


def final_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Each phrase with the winner it repeats: equal text first, else near-identical boxes. No transitive merging."""
    return folds.greedy(_ranked_final(spark, d), ["image_id"], "quality", 0.75, ("phrase",)).select("image_id", "det_no", F.col("winner").cast("int").alias("winner"))


def unique_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Alignments by detector support and score; later ones on a kept target are demoted and linked to it."""
    det = X.detections(spark, d)
    order = Window.partitionBy("image_id").orderBy(F.coalesce("score", F.lit(0.0)).desc(), "det_no")
    ranked = det.select("image_id", "det_no", "x1", "y1", "x2", "y2", F.row_number().over(order).alias("quality"))
    linked = folds.greedy(ranked, ["image_id"], "quality", 0.5)
    return linked.select("image_id", "det_no", F.col("winner").isNull().alias("accepted"), F.col("winner").cast("int").alias("duplicate_of"))


def peer_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Peers of one category without near-copies; each image's first detection is preferred."""
    det = X.detections(spark, d)
    order = Window.partitionBy(*KEYS).orderBy((F.col("det_no") != 1), "det_no")
    ranked = det.select(*KEYS, "det_no", "x1", "y1", "x2", "y2", F.row_number().over(order).alias("rank"))
    return folds.suppress(ranked, KEYS, "rank", 0.85).select(*KEYS, "det_no")


def promotion_topk(spark: SparkSession, d: str) -> DataFrame:
    """Category detections that overlap no locator detection, thinned, the best three of each image."""
    det = X.detections(spark, d)
    free = spatial.without_overlap(det.filter("query_type = 'category'"), det.filter("query_type = 'locator'"), ["image_id"], ["image_id", "det_no"], 0.5)
    order = Window.partitionBy("image_id").orderBy(F.coalesce("score", F.lit(0.0)).desc(), "det_no")
    ranked = free.select("image_id", "det_no", "x1", "y1", "x2", "y2", F.row_number().over(order).alias("rank"))
    kept = folds.suppress(ranked, ["image_id"], "rank", 0.85)
    place = F.row_number().over(Window.partitionBy("image_id").orderBy("rank"))
    return kept.withColumn("place", place.cast("int")).filter("place <= 3").select("image_id", "det_no", "place")


def hint_admission(spark: SparkSession, d: str) -> DataFrame:
    """Regions admitted in order unless one admitted before overlaps by 0.8."""
    det = X.detections(spark, d)
    return folds.suppress(det.select("image_id", "det_no", "x1", "y1", "x2", "y2"), ["image_id"], "det_no", 0.8).select("image_id", "det_no")


def unmatched_boxes(spark: SparkSession, d: str) -> DataFrame:
    det = X.detections(spark, d)
    return spatial.without_overlap(det.filter("query_type = 'locator'"), det.filter("query_type = 'category'"), ["image_id"], ["image_id", "det_no"], 0.5).select("image_id", "det_no")


def near_rows(spark: SparkSession, d: str) -> DataFrame:
    """Detections near each other: one in the other, or among the two nearest."""
    det = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    return spatial.near_rows(det, "image_id", "det_no", k=2).select("image_id", "det_no", "other", F.col("place").cast("int").alias("place"))


def competitors(spark: SparkSession, d: str) -> DataFrame:
    """For each detection the others called alike, by category and by word of its query, as classes with their sizes."""
    words = F.split(F.lower(F.concat_ws(" ", "grounder", "query_type")), r"\s+")
    return spatial.peer_classes(X.detections(spark, d), "image_id", "det_no", {"category": F.array("category"), "word": words})


QUERIES = [nms_within_detector, pair_match, components, cluster_stats, representative_box, consensus_instances, consensus_rejections, reground_audit, repair_top2, size_assess, duplicate_suspects, final_dedup, unique_alignments, peer_candidates, promotion_topk, hint_admission, unmatched_boxes, near_rows, competitors]


def _fold_sql(view: str, keys: str, rank: str, like: str) -> str:
    """Greedy selection of ``view`` as two expressions: kept(keys, d) with d a struct of det_no, the box and rank."""
    return f"""kept AS (
  SELECT {keys}, unnest(list_reduce(list_transform(list(struct_pack(rk := {rank}, det_no := det_no, x1 := x1, y1 := y1, x2 := x2, y2 := y2) ORDER BY {rank}), lambda x: [x]),
    lambda acc, y: CASE WHEN len(list_filter(acc, lambda k: {like.replace('@a', 'k').replace('@b', 'y[1]')})) > 0 THEN acc ELSE acc || y END)) AS d
  FROM {view} GROUP BY {keys})"""


def _iou_at(threshold: float) -> str:
    return f"{X.iou('@a', '@b')} >= {threshold}"


_RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY image_id, category, grounder
  ORDER BY (query_type = 'locator') DESC, (score IS NOT NULL) DESC, coalesce(score, 0) DESC, det_no) AS rk FROM det)"""


def _cluster_sql(source: str) -> str:
    return f"""edges AS (SELECT a.image_id, a.category, a.det_no AS a, b.det_no AS b FROM {source} a JOIN {source} b
    ON a.image_id = b.image_id AND a.category = b.category AND a.det_no < b.det_no AND a.grounder <> b.grounder AND {X.matched('a', 'b')}),
  both_ways AS (SELECT image_id, category, a, b FROM edges UNION SELECT image_id, category, b, a FROM edges),
  reach AS (SELECT image_id, category, a AS node, a AS root FROM both_ways
    UNION SELECT r.image_id, r.category, e.b, r.root FROM reach r JOIN both_ways e ON e.image_id = r.image_id AND e.category = r.category AND e.a = r.node),
  labels AS (SELECT image_id, category, node, min(root) AS cluster FROM reach GROUP BY ALL),
  members AS (SELECT s.*, coalesce(l.cluster, s.det_no) AS cluster FROM {source} s LEFT JOIN labels l
    ON l.image_id = s.image_id AND l.category = s.category AND l.node = s.det_no)"""


_STATS = f"""pairs AS (SELECT a.image_id, a.category, a.cluster, {X.iou('a', 'b')} AS o, {X.matched('a', 'b')} AS ok FROM members a JOIN members b
    ON a.image_id = b.image_id AND a.category = b.category AND a.cluster = b.cluster AND a.det_no < b.det_no AND a.grounder <> b.grounder),
  per_pair AS (SELECT image_id, category, cluster, count(*) FILTER (WHERE ok) AS matched_pairs, median(o) AS median_iou FROM pairs GROUP BY ALL),
  per_member AS (SELECT image_id, category, cluster, string_agg(DISTINCT grounder, ',' ORDER BY grounder) AS detectors, count(DISTINCT grounder) AS support,
    avg(score) AS mean_score, count(*) AS members FROM members GROUP BY ALL),
  stats AS (SELECT m.*, coalesce(p.matched_pairs, 0) AS matched_pairs, coalesce(p.median_iou, 0.0) AS median_iou
    FROM per_member m LEFT JOIN per_pair p ON m.image_id = p.image_id AND m.category = p.category AND m.cluster = p.cluster)"""

_REPRESENTATIVE = f"""means AS (SELECT a.image_id, a.category, a.cluster, a.det_no, a.grounder, a.score, a.x1, a.y1, a.x2, a.y2,
    round(coalesce(avg(CASE WHEN b.det_no IS NOT NULL THEN {X.iou('a', 'b')} END), 0.0), 9) AS m
    FROM members a LEFT JOIN members b ON a.image_id = b.image_id AND a.category = b.category AND a.cluster = b.cluster AND a.grounder <> b.grounder GROUP BY ALL),
  reps AS (SELECT *, row_number() OVER (PARTITION BY image_id, category, cluster ORDER BY m DESC, (score IS NOT NULL) DESC, coalesce(score, 0) DESC, det_no) AS n FROM means
    QUALIFY n = 1)"""

_INSTANCES = (
    X.with_views("det", "size", recursive=True)
    + f""",
  {_RANKED},
  {_fold_sql('ranked', 'image_id, category, grounder', 'rk', _iou_at(0.95))},
  thin AS (SELECT t.* FROM det t JOIN kept k ON t.image_id = k.image_id AND t.category = k.category AND t.det_no = k.d.det_no),
  {_cluster_sql('thin')},
  {_STATS},
  {_REPRESENTATIVE},
  found AS (SELECT s.*, r.x1, r.y1, r.x2, r.y2, s.cluster AS det_no FROM stats s JOIN reps r ON s.image_id = r.image_id AND s.category = r.category AND s.cluster = r.cluster WHERE support >= 2),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY image_id, category ORDER BY support DESC, matched_pairs DESC, median_iou DESC, coalesce(mean_score, 0) DESC, members, cluster) AS rk FROM found),
  """
    + _fold_sql("ordered", "image_id, category", "rk", _iou_at(0.85)).replace("kept AS", "winners AS")
    + """,
  instances AS (SELECT f.*, CAST(row_number() OVER (PARTITION BY f.image_id, f.category ORDER BY f.y1, f.x1, f.y2, f.x2, f.cluster) AS INT) AS instance_no
    FROM found f JOIN winners w ON f.image_id = w.image_id AND f.category = w.category AND f.cluster = w.d.det_no)
"""
)


def _band(ratio: str, low: float, high: float, most: float) -> str:
    return f"CASE WHEN {ratio} < {low} THEN 'borderline_small' WHEN {ratio} <= {high} THEN 'preferred' WHEN {ratio} <= {most} THEN 'large_acceptable' ELSE 'too_large' END"


_RATIO = f"({X.area('f')} / CAST(width * height AS DOUBLE))"

SQL = {
    "nms_within_detector": X.with_views("det") + f",\n{_RANKED},\n{_fold_sql('ranked', 'image_id, category, grounder', 'rk', _iou_at(0.95))}\nSELECT image_id, category, grounder, d.det_no AS det_no FROM kept",
    "pair_match": X.with_views("det") + f"""
SELECT a.image_id, a.category, a.det_no AS first, b.det_no AS second FROM det a JOIN det b
ON a.image_id = b.image_id AND a.category = b.category AND a.det_no < b.det_no AND a.grounder <> b.grounder AND {X.matched('a', 'b')}""",
    "components": X.with_views("det", recursive=True) + f",\n{_cluster_sql('det')}\nSELECT image_id, category, det_no, cluster FROM members",
    "cluster_stats": X.with_views("det", recursive=True) + f""",\n{_cluster_sql('det')},\n{_STATS}
SELECT image_id, category, cluster, detectors, support, matched_pairs, round(median_iou, 6) AS median_iou, round(mean_score, 6) AS mean_score, members FROM stats""",
    "representative_box": X.with_views("det", recursive=True) + f""",\n{_cluster_sql('det')},\n{_REPRESENTATIVE}
SELECT image_id, category, cluster, x1, y1, x2, y2, grounder AS representative, 'detection_medoid' AS method FROM reps""",
    "consensus_instances": _INSTANCES + f"""SELECT f.image_id, f.category, f.instance_no, f.x1, f.y1, f.x2, f.y2, f.support, round(f.median_iou, 6) AS median_iou, round(f.mean_score, 6) AS mean_score,
  {_band(_RATIO, 0.001, 0.1, 0.1)} AS size_band, {_RATIO} >= 0.00001 AND {_RATIO} <= 0.1 AS size_pass FROM instances f JOIN size s ON s.image_id = f.image_id""",
    "consensus_rejections": _INSTANCES + """, counted AS (SELECT image_id, category, grounder, count(*) AS n FROM det GROUP BY ALL)
SELECT image_id, category, string_agg(grounder || '=' || n, ',' ORDER BY grounder) AS detector_counts, 'no_multi_grounder_entity_instance' AS reject_reason
FROM counted c WHERE NOT EXISTS (SELECT 1 FROM instances i WHERE i.image_id = c.image_id AND i.category = c.category) GROUP BY image_id, category""",
    "reground_audit": _INSTANCES + f""", judged AS (SELECT t.image_id, t.category, t.det_no AS target_no, f.support, {X.iou('f', 't')} AS o, f.median_iou AS m, f.support IS NOT NULL AS there,
    f.support IS NOT NULL AND {X.iou('f', 't')} >= 0.5 AND {X.size_ratio('f', 't')} <= 1.25 AS hit
    FROM det t LEFT JOIN instances f ON f.image_id = t.image_id AND f.category = t.category),
  best AS (SELECT *, row_number() OVER (PARTITION BY image_id, category, target_no ORDER BY hit DESC, support DESC NULLS LAST, o DESC, m DESC) AS n FROM judged),
  summed AS (SELECT image_id, category, target_no, count(*) FILTER (WHERE there) AS cluster_count, count(*) FILTER (WHERE hit) AS target_count, max(support) AS any_support FROM judged GROUP BY ALL)
SELECT s.image_id, s.category, s.target_no, cluster_count, target_count, CASE WHEN b.hit THEN b.support ELSE coalesce(any_support, 0) END AS support,
  round(CASE WHEN b.hit THEN b.o ELSE 0.0 END, 9) AS reground_iou,
  CASE WHEN cluster_count = 0 THEN 'no_multi_grounder_expression_result' WHEN target_count = 0 THEN 'expression_did_not_recover_target'
       WHEN cluster_count > 1 THEN 'expression_has_multiple_consensus_targets' END AS reason, cluster_count = 1 AND target_count = 1 AS passed
FROM summed s JOIN best b ON b.image_id = s.image_id AND b.category = s.category AND b.target_no = s.target_no AND b.n = 1""",
    "repair_top2": X.with_views("det", "size") + f""", small AS (SELECT a.image_id, a.category, c.det_no AS target_no, a.det_no, a.x1, a.y1, a.x2, a.y2,
    row_number() OVER (PARTITION BY a.image_id, a.category, c.det_no, a.x1, a.y1, a.x2, a.y2 ORDER BY a.det_no) AS nth
    FROM det a JOIN det c ON a.image_id = c.image_id AND a.category = c.category JOIN size s ON s.image_id = a.image_id
    WHERE {X.area('a')} < {X.area('c')} AND {X.containment('a', 'c')} >= 0.98
    AND {X.area('a')} / CAST(width * height AS DOUBLE) >= 0.00001 AND {X.area('a')} / CAST(width * height AS DOUBLE) <= 0.1 QUALIFY nth = 1),
  backed AS (SELECT f.image_id, f.category, f.target_no, f.det_no, f.x1, f.y1, f.x2, f.y2, count(DISTINCT s.grounder) AS support FROM small f JOIN det s
    ON f.image_id = s.image_id AND f.category = s.category AND {X.iou('f', 's')} >= 0.5 GROUP BY ALL HAVING count(DISTINCT s.grounder) >= 2)
SELECT image_id, category, target_no, det_no, support, CAST(row_number() OVER (PARTITION BY image_id, category, target_no ORDER BY support DESC, {X.area('b')}, det_no) AS INT) AS place FROM backed b QUALIFY place <= 2""",
    "size_assess": X.with_views("det", "size") + f"""
SELECT f.image_id, det_no, least(x2 - x1, y2 - y1) AS bbox_short_side_px, {_RATIO} AS bbox_area_ratio, {_band(_RATIO, 0.01, 0.02, 0.03)} AS size_band,
  {_RATIO} >= 0.00001 AND {_RATIO} <= 0.03 AS size_pass,
  CASE WHEN {_RATIO} < 0.00001 THEN 'bbox_area_below_0_001_percent' WHEN {_RATIO} > 0.03 THEN 'bbox_area_above_3_percent' END AS size_reject_reason
FROM det f JOIN size s ON s.image_id = f.image_id""",
    "duplicate_suspects": X.with_views("expr") + f""", t AS (SELECT *, CASE WHEN det_no % 2 = 0 THEN lower(trim(expression)) ELSE '' END AS phrase FROM expr),
  texts AS (SELECT image_id, min(det_no) OVER (PARTITION BY image_id, phrase) AS first, det_no AS second, 'text' AS tier FROM t WHERE phrase <> ''),
  boxes AS (SELECT a.image_id, a.det_no AS first, b.det_no AS second, CASE WHEN a.category_query = b.category_query AND {X.iou('a', 'b')} >= 0.98 THEN 'identical' ELSE 'undecided' END AS tier
    FROM t a JOIN t b ON a.image_id = b.image_id AND a.det_no < b.det_no WHERE (a.phrase <> b.phrase OR a.phrase = '') AND {X.iou('a', 'b')} >= 0.75
    AND ((a.category_query = b.category_query AND {X.iou('a', 'b')} >= 0.98) OR ({X.size_ratio('a', 'b')} <= 1 / 0.7 AND
      greatest(abs((a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2) / least(a.x2 - a.x1, b.x2 - b.x1), abs((a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2) / least(a.y2 - a.y1, b.y2 - b.y1)) <= 0.2)))
SELECT * FROM texts WHERE first <> second UNION ALL SELECT * FROM boxes""",
    "final_dedup": X.with_views("expr") + f""", q AS (SELECT *, lower(trim(expression)) AS phrase, row_number() OVER (PARTITION BY image_id ORDER BY x2 - x1 DESC, revision, det_no) AS rk FROM expr),
  folded AS (SELECT image_id, unnest(list_reduce(list_transform(list(struct_pack(rk := rk, det_no := det_no, phrase := phrase, x1 := x1, y1 := y1, x2 := x2, y2 := y2) ORDER BY rk), lambda x: [x]),
    lambda acc, y: CASE WHEN len(list_filter(acc, lambda k: k.phrase = y[1].phrase OR {X.iou('k', 'y[1]')} >= 0.75)) > 0 THEN acc ELSE acc || y END)) AS d FROM q GROUP BY image_id)
SELECT q.image_id, q.det_no, CAST(CASE WHEN max(CASE WHEN d.det_no = q.det_no THEN 1 ELSE 0 END) = 1 THEN NULL
  ELSE min(CASE WHEN d.rk < q.rk AND (d.phrase = q.phrase OR {X.iou('d', 'q')} >= 0.75) THEN d.rk END) END AS INT) AS winner
FROM q JOIN folded f ON f.image_id = q.image_id GROUP BY q.image_id, q.det_no""",
    "unique_alignments": X.with_views("det") + f""", q AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY coalesce(score, 0) DESC, det_no) AS rk FROM det),
{_fold_sql('q', 'image_id', 'rk', _iou_at(0.5))}
SELECT q.image_id, q.det_no, max(CASE WHEN d.det_no = q.det_no THEN 1 ELSE 0 END) = 1 AS accepted, CAST(CASE WHEN max(CASE WHEN d.det_no = q.det_no THEN 1 ELSE 0 END) = 0
  THEN min(CASE WHEN d.rk < q.rk AND {X.iou('d', 'q')} >= 0.5 THEN d.rk END) END AS INT) AS duplicate_of FROM q JOIN kept ON kept.image_id = q.image_id GROUP BY q.image_id, q.det_no""",
    "peer_candidates": X.with_views("det") + f""", q AS (SELECT *, row_number() OVER (PARTITION BY image_id, category ORDER BY det_no <> 1, det_no) AS rk FROM det),
{_fold_sql('q', 'image_id, category', 'rk', _iou_at(0.85))} SELECT image_id, category, d.det_no AS det_no FROM kept""",
    "promotion_topk": X.with_views("det") + f""", free AS (SELECT * FROM det a WHERE query_type = 'category' AND NOT EXISTS
    (SELECT 1 FROM det b WHERE b.image_id = a.image_id AND b.query_type = 'locator' AND {X.iou('a', 'b')} >= 0.5)),
  q AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY coalesce(score, 0) DESC, det_no) AS rk FROM free),
{_fold_sql('q', 'image_id', 'rk', _iou_at(0.85))}
SELECT image_id, d.det_no AS det_no, CAST(row_number() OVER (PARTITION BY image_id ORDER BY d.rk) AS INT) AS place FROM kept QUALIFY place <= 3""",
    "hint_admission": X.with_views("det") + f",\n{_fold_sql('det', 'image_id', 'det_no', _iou_at(0.8))} SELECT image_id, d.det_no AS det_no FROM kept",
    "unmatched_boxes": X.with_views("det") + f"""
SELECT image_id, det_no FROM det a WHERE query_type = 'locator' AND NOT EXISTS (SELECT 1 FROM det b WHERE b.image_id = a.image_id AND b.query_type = 'category' AND {X.iou('a', 'b')} >= 0.5)""",
    "near_rows": X.with_views("det", "size") + f""", p AS (SELECT a.image_id, a.det_no, b.det_no AS other,
    greatest({X.containment('a', 'b')}, {X.containment('b', 'a')}) >= 0.6 AS over,
    ((b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2) / width * (((b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2) / width) + ((b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2) / height * (((b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2) / height) AS dist
    FROM det a JOIN det b ON a.image_id = b.image_id AND a.det_no <> b.det_no JOIN size s ON s.image_id = a.image_id),
  n AS (SELECT *, row_number() OVER (PARTITION BY image_id, det_no ORDER BY dist, other) AS k FROM p)
SELECT image_id, det_no, other, CAST(row_number() OVER (PARTITION BY image_id, det_no ORDER BY dist, other) AS INT) AS place FROM n WHERE over OR k <= 2""",
    "competitors": X.with_views("det") + """, c AS (SELECT image_id, det_no, 'category' AS kind, category AS value FROM det
    UNION ALL SELECT image_id, det_no, 'word', grounder FROM det UNION ALL SELECT image_id, det_no, 'word', query_type FROM det)
SELECT image_id, det_no, kind, value, count(*) OVER (PARTITION BY image_id, kind, value) - 1 AS others FROM c""",
}
