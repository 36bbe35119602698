"""Instances on which several detectors agree.

Detections of one key (an image and what was looked for) are thinned within each detector, joined across detectors where
their boxes match, and the connected components become instances with statistics, a representative box, a size verdict
and a number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import area, box, containment, iou, matches, size_columns, size_ratio
from sightline.operators.components import keyed_components
from sightline.operators.folds import suppress
from sightline.operators.spatial import overlapping_pairs
from sightline.session import written


@dataclass(frozen=True)
class Rules:
    min_support: int = 2
    min_iou: float = 0.5
    min_containment: float = 0.8
    max_size_ratio: float = 3.0
    within_detector_iou: float = 0.95
    instance_iou: float = 0.85
    regrounding_size_ratio: float = 1.25
    mask_detector: str = "sam31"


def thinned(detections: DataFrame, keys: list[str], row: str, rules: Rules = Rules()) -> DataFrame:
    """Detections without near-copies from the same detector. Locator results come first, then scored ones by score, then
    those with a mask (where there is a column tx1), then the earliest row."""
    masked = [F.col("tx1").isNotNull().desc()] if "tx1" in detections.columns else []
    order = [(F.col("query_type") == "locator").desc_nulls_last(), F.col("score").isNotNull().desc(), F.coalesce("score", F.lit(0.0)).desc(), *masked, F.col(row)]
    ranked = detections.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "grounder").orderBy(*order)))
    return suppress(ranked, [*keys, "grounder"], "_rank", rules.within_detector_iou).drop("_rank")


def _matched(a: str, b: str, rules: Rules) -> Column:
    return matches(box(a), box(b), rules.min_iou, rules.min_containment, rules.max_size_ratio)


def matched_pairs(detections: DataFrame, keys: list[str], row: str, rules: Rules = Rules()) -> DataFrame:
    """Pairs of different detectors that show one thing: keys, first, second."""
    condition = (F.col(f"a.{row}") < F.col(f"b.{row}")) & (F.col("a.grounder") != F.col("b.grounder")) & _matched("a.", "b.", rules)
    pairs = overlapping_pairs(detections, detections, keys, condition)
    return pairs.select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{row}").alias("first"), F.col(f"b.{row}").alias("second"))


def clustered(detections: DataFrame, keys: list[str], row: str, rules: Rules = Rules(), alone: bool = True) -> DataFrame:
    """``detections`` with ``cluster``: the least row of the component each belongs to.

    Without ``alone``, detections that match none are left out; they can only be clusters of one detector.
    """
    edges = matched_pairs(detections, keys, row, rules).withColumnsRenamed({"first": "a", "second": "b"})
    labels = keyed_components(edges, keys).withColumnsRenamed({"node": row, "component": "_least"})
    joined = detections.join(labels, [*keys, row], "left" if alone else "inner")
    return joined.withColumn("cluster", F.coalesce("_least", F.col(row))).drop("_least")


def summaries(members: DataFrame, keys: list[str], row: str, rules: Rules = Rules()) -> DataFrame:
    """One row per cluster: detectors, support, matched_pairs, median_iou, mean_score, members, and the box that stands for it
    (x1..y2, representative, method).

    The median runs over all cross-detector pairs of a cluster, 0 if there are none; null scores do not count. The box is
    that with the greatest mean IoU to the other detectors' boxes, scored ones and higher scores first among equals, then
    the earliest row. If ``members`` has the columns tx1..ty2 (the tight box of a mask, null where there is none), a tight
    box of the mask detector that still matches another detector's box goes before all detected boxes.

    Members of a cluster meet once, across detectors only; both sums follow in the same partitions. Clusters are small by
    nature: near-copies of one detector are thinned out before.
    """
    by, corners = [*keys, "cluster"], ["x1", "y1", "x2", "y2"]
    slim = members.select(*by, F.col(row).alias("_row"), "grounder", "score", *corners)
    options = slim.withColumn("_tight", F.lit(0))
    if "tx1" in members.columns:
        tight = members.filter((F.col("grounder") == rules.mask_detector) & F.col("tx1").isNotNull())
        options = options.unionByName(tight.select(*by, F.col(row).alias("_row"), "grounder", "score", *[F.col("t" + c).alias(c) for c in corners], F.lit(1).alias("_tight")))
    a, b = options.alias("a"), slim.drop("score").alias("b")
    met = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in by] + [F.col("a.grounder") != F.col("b.grounder")], "left")
    there, once = F.col("b._row").isNotNull(), (F.col("a._tight") == 0) & (F.col("a._row") < F.col("b._row"))
    measured = met.select("a.*", F.when(there, iou(box("a."), box("b."))).alias("_iou"), F.when(there, _matched("a.", "b.", rules)).alias("_ok"), F.coalesce(once, F.lit(False)).alias("_once"))
    each = measured.groupBy(*by, "_row", "_tight", "grounder", "score", *corners).agg(
        F.round(F.coalesce(F.avg("_iou"), F.lit(0.0)), 9).alias("_mean"), F.bool_or("_ok").alias("_any"),
        F.count_if(F.col("_ok") & F.col("_once")).alias("_pairs"), F.collect_list(F.when(F.col("_once"), F.col("_iou"))).alias("_ious"),
    )
    seen, able = F.col("_tight") == 0, (F.col("_tight") == 0) | F.coalesce("_any", F.lit(False))
    chosen = F.struct("grounder", *corners, F.when(F.col("_tight") == 1, "mask_tight").otherwise("detection_medoid").alias("method"))
    rank = F.struct("_tight", "_mean", F.col("score").isNotNull(), F.coalesce("score", F.lit(0.0)), -F.col("_row"))
    d = each.groupBy(*by).agg(
        F.array_sort(F.collect_set("grounder")).alias("detectors"), F.count_distinct("grounder").alias("support"), F.sum("_pairs").alias("matched_pairs"),
        F.avg(F.when(seen, F.col("score"))).alias("mean_score"), F.count_if(seen).alias("members"),
        F.sort_array(F.flatten(F.collect_list("_ious"))).alias("_all"), F.max_by(F.when(able, chosen), F.when(able, rank)).alias("_b"),
    )
    n = F.size("_all")
    middle = F.when(n > 0, (F.get("_all", F.floor((n - 1) / 2).cast("int")) + F.get("_all", F.floor(n / 2).cast("int"))) / 2).otherwise(0.0)
    return d.select(*by, "detectors", "support", "matched_pairs", middle.alias("median_iou"), "mean_score", "members", *[F.col("_b")[c].alias(c) for c in corners], F.col("_b")["grounder"].alias("representative"), F.col("_b")["method"].alias("method"))


def cluster_statistics(members: DataFrame, keys: list[str], row: str, rules: Rules = Rules()) -> DataFrame:
    """The statistics of ``summaries``."""
    return summaries(members, keys, row, rules).select(*keys, "cluster", "detectors", "support", "matched_pairs", "median_iou", "mean_score", "members")


def representatives(members: DataFrame, keys: list[str], row: str, rules: Rules = Rules()) -> DataFrame:
    """The boxes of ``summaries``."""
    return summaries(members, keys, row, rules).select(*keys, "cluster", "x1", "y1", "x2", "y2", "representative", "method")


def instances(detections: DataFrame, images: DataFrame, keys: list[str], row: str, rules: Rules = Rules(), sized: bool = True) -> DataFrame:
    """Numbered instances of every key: statistics, box, method, size columns, instance_no.

    Instances that another, better supported one covers are dropped; the rest are numbered from top to bottom, then left
    to right. ``images`` (with image_id, width, height) is joined only if ``sized``.
    """
    thin = written(thinned(detections, keys, row, rules), "thinned")
    members = clustered(thin, keys, row, rules, alone=rules.min_support < 2)
    found = summaries(members, keys, row, rules).filter(F.col("support") >= rules.min_support)
    if sized:
        b = box()
        found = found.join(images.select("image_id", "width", "height"), "image_id").withColumns(size_columns(b, F.col("width"), F.col("height")))
    order = [F.desc("support"), F.desc("matched_pairs"), F.desc("median_iou"), F.coalesce("mean_score", F.lit(0.0)).desc(), F.asc("members"), F.asc("cluster")]
    ranked = found.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = suppress(ranked, keys, "_rank", rules.instance_iou).drop("_rank")
    place = Window.partitionBy(*keys).orderBy("y1", "x1", "y2", "x2", "cluster")
    return kept.withColumn("instance_no", F.row_number().over(place))


def rejections(detections: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without any instance, with how many detections each detector gave: keys, counts (a map), reject_reason."""
    counted = detections.groupBy(*keys, "grounder").agg(F.count("*").alias("n"))
    per_key = counted.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("grounder", "n")))).alias("counts"))
    return per_key.join(found.select(*keys).distinct(), keys, "left_anti").withColumn("reject_reason", F.lit("no_multi_grounder_entity_instance"))


def regrounding_audit(targets: DataFrame, clusters: DataFrame, keys: list[str], rules: Rules = Rules(), target: str | None = None) -> DataFrame:
    """Whether a phrase leads back to its target alone: cluster_count, target_count, support, reground_iou, reason, passed.

    ``targets`` has one box per key, ``clusters`` any number with support and median_iou. With ``target``, the column
    that tells the targets of one key apart, each target is audited by itself and the column is returned after the keys.
    """
    t, c = targets.alias("t"), clusters.alias("c")
    per = [*keys, target] if target else keys
    j = t.join(c, [F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys], "left")
    there = F.col("c.support").isNotNull()
    overlap = iou(box("c."), box("t."))
    hit = there & (overlap >= rules.min_iou) & (size_ratio(box("c."), box("t.")) <= rules.regrounding_size_ratio)
    best = F.max(F.when(hit, F.struct(F.col("c.support").alias("s"), overlap.alias("o"), F.col("c.median_iou").alias("m"))))
    d = j.groupBy(*[F.col(f"t.{k}").alias(k) for k in per]).agg(F.count_if(there).alias("cluster_count"), F.count_if(hit).alias("target_count"), best.alias("_b"), F.max("c.support").alias("_any"))
    reason = (
        F.when(F.col("cluster_count") == 0, "no_multi_grounder_expression_result")
        .when(F.col("target_count") == 0, "expression_did_not_recover_target")
        .when(F.col("cluster_count") > 1, "expression_has_multiple_consensus_targets")
    )
    return d.select(
        *per, "cluster_count", "target_count", F.coalesce(F.col("_b")["s"], "_any", F.lit(0)).alias("support"), F.coalesce(F.col("_b")["o"], F.lit(0.0)).alias("reground_iou"),
        reason.alias("reason"), ((F.col("cluster_count") == 1) & (F.col("target_count") == 1)).alias("passed"),
    )


def geometry_audit(targets: DataFrame, boxes: DataFrame, keys: list[str], target: str, rules: Rules = Rules()) -> DataFrame:
    """Whether what was found for a target is its box alone: keys, target, box_count, reground_iou, passed, reason.

    Passed: exactly one box of the target's key, with enough overlap and a like size. The IoU reported is the greatest over
    all boxes of the key, 0 if none overlaps. Boxes that overlap are found through the grid.
    """
    counted = boxes.groupBy(*keys).agg(F.count("*").alias("box_count"))
    a, b = box("a."), box("b.")
    near = overlapping_pairs(targets, boxes, keys, iou(a, b) > 0)
    best = near.groupBy(*[F.col(f"a.{k}").alias(k) for k in [*keys, target]]).agg(F.max(F.struct(iou(a, b).alias("o"), size_ratio(a, b).alias("r"))).alias("_b"))
    d = targets.select(*keys, target).join(counted, keys, "left").join(best, [*keys, target], "left")
    n, o = F.coalesce("box_count", F.lit(0)), F.coalesce(F.col("_b")["o"], F.lit(0.0))
    passed = (n == 1) & (o >= rules.min_iou) & F.coalesce(F.col("_b")["r"] <= rules.regrounding_size_ratio, F.lit(False))
    reason = F.when(passed, None).when(n == 0, "no_valid_locator_box").otherwise("locator_target_disagreement")
    return d.select(*keys, target, n.alias("box_count"), o.alias("reground_iou"), passed.alias("passed"), reason.alias("reason"))


def repair_options(members: DataFrame, candidates: DataFrame, keys: list[str], row: str, rules: Rules = Rules(), limit: int = 2, target: str | None = None) -> DataFrame:
    """Smaller boxes of a candidate's own members that could replace its box: keys, row, box, support, place.

    A repair is smaller than the candidate's box, lies within it by 98 %, has a size that passes and overlaps boxes of
    enough detectors. ``candidates`` has the box, width and height per key. With ``target``, the column that tells the
    candidates of one key apart, each has repairs of its own and the column is returned after the keys.
    """
    per = [*keys, target] if target else keys
    c, m, s = candidates.alias("c"), members.alias("a"), members.alias("s")
    on = lambda x, y: [F.col(f"{x}.{k}") == F.col(f"{y}.{k}") for k in keys]
    a, t = box("a."), box("c.")
    small = m.join(c, on("a", "c")).filter((area(a) < area(t)) & (containment(a, t) >= 0.98))
    small = small.filter(size_columns(a, F.col("c.width"), F.col("c.height"))["size_pass"])
    flat = small.select(*[F.col(f"a.{k}").alias(k) for k in keys], *[F.col(f"c.{k}").alias(k) for k in per[len(keys) :]], F.col(f"a.{row}").alias(row), *[F.col(f"a.{x}").alias(x) for x in ("x1", "y1", "x2", "y2")])
    first = Window.partitionBy(*per, "x1", "y1", "x2", "y2").orderBy(row)
    flat = flat.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n").alias("f")
    backed = flat.join(s, on("f", "s") + [iou(box("f."), box("s.")) >= rules.min_iou])
    supported = backed.groupBy(*[F.col(f"f.{x}").alias(x) for x in [*per, row, "x1", "y1", "x2", "y2"]]).agg(F.count_distinct("s.grounder").alias("support")).filter(F.col("support") >= rules.min_support)
    order = Window.partitionBy(*per).orderBy(F.desc("support"), area(box()), F.col(row))
    return supported.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
