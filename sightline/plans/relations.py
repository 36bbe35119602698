"""Queries of boxes, joins, counts, windows and set comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.functions import geometry as G
from sightline.functions import text as T
from sightline.operators import relational as R
from sightline.plans import fixtures as X
from sightline.sources import table


def box_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Each detection against the first one of its image."""
    det = X.detections(spark, d)
    first = det.filter("det_no = 1").select("image_id", *[F.col(c).alias("f" + c) for c in ("x1", "y1", "x2", "y2")])
    j = det.join(first, "image_id").join(X.sizes(spark, d), "image_id")
    a, b = G.box(), G.box("f")
    return j.select("image_id", "det_no", G.area(a).alias("area"), G.area_ratio(a, F.col("width"), F.col("height")).alias("area_ratio"), G.iou(a, b).alias("iou"), G.containment(a, b).alias("contained"), G.center_offset(a, b).alias("center_offset"))


def clipped_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes moved to the right and clipped to the image, with their validity."""
    j = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    b = G.box()
    moved = G.Box(b.x1 * 12, b.y1 * 9, b.x2 * 12, b.y2 * 9)
    c = G.clip(moved, F.col("width"), F.col("height"))
    return j.select("image_id", "det_no", *[v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), c)], G.is_valid(c, F.col("width"), F.col("height")).alias("valid"))


def normalized_region(spark: SparkSession, d: str) -> DataFrame:
    """Boxes read as regions of 0..1000, padded, as pixels; null where the region is invalid."""
    j = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    b = G.box()
    region = G.Box(b.x1 * 10, b.y1 * 10, b.x2 * 11, b.y2 * 11)
    p = G.region_to_pixels(region, F.col("width"), F.col("height"), 0.2)
    return j.select("image_id", "det_no", *[v.alias("p" + n) for n, v in zip(("x1", "y1", "x2", "y2"), p)])


def crop_to_original(spark: SparkSession, d: str) -> DataFrame:
    """Boxes found in a 100 x 200 crop of the window (100, 50) to (300, 350), in image coordinates."""
    window = G.Box(*[F.lit(v) for v in (100.0, 50.0, 300.0, 350.0)])
    c = G.crop_to_original(G.box(), window, F.lit(100.0), F.lit(200.0))
    return X.detections(spark, d).select("image_id", "det_no", *[v.alias("o" + n) for n, v in zip(("x1", "y1", "x2", "y2"), c)])


def expand_view(spark: SparkSession, d: str) -> DataFrame:
    """Context windows: three times the box, at least 15 % of the image; and the box padded by a fifth."""
    j = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    e = G.expand(G.box(), F.col("width"), F.col("height"), 3.0, 0.15)
    p = G.padded(G.box(), F.col("width"), F.col("height"), 0.2)
    names = ("x1", "y1", "x2", "y2")
    return j.select("image_id", "det_no", *[v.alias("e" + n) for n, v in zip(names, e)], *[v.alias("p" + n) for n, v in zip(names, p)])


def unit_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes given as shares of the image, by corner and by centre."""
    x, y, w, h = F.col("x1") / 128, F.col("y1") / 128, (F.col("x2") - F.col("x1")) / 256, (F.col("y2") - F.col("y1")) / 256
    j = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    a, c = G.from_unit_xywh(x, y, w, h, F.col("width"), F.col("height")), G.from_unit_center(x, y, w, h, F.col("width"), F.col("height"))
    names = ("x1", "y1", "x2", "y2")
    return j.select("image_id", "det_no", *[F.round(v, 6).alias("a" + n) for n, v in zip(names, a)], *[F.round(v, 6).alias("c" + n) for n, v in zip(names, c)])


def union_envelope(spark: SparkSession, d: str) -> DataFrame:
    return X.detections(spark, d).groupBy("image_id", "category").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def category_requests(spark: SparkSession, d: str) -> DataFrame:
    """One request per image and category query of the proposals, whoever proposed it."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "category", "category_query").filter("category_query is not null")
    query = F.lower(F.col("category_query"))
    g = e.groupBy("image_id", query.alias("query")).agg(F.min("rank").alias("rank"), F.count_distinct("entity_id").alias("entities"), F.count_distinct("category").alias("spellings"), F.min_by("entity_id", F.struct("rank", "entity_id")).alias("first_entity"))
    return g.withColumn("suffix", T.short_hash(F.col("query")))


def request_members(spark: SparkSession, d: str) -> DataFrame:
    """The entities that share each category request, one row each."""
    e = table(spark, d, "entities", "image_id", "entity_id", "category_query").filter("category_query is not null")
    return e.select("image_id", F.lower("category_query").alias("query"), "entity_id").distinct()


def locator_requests(spark: SparkSession, d: str) -> DataFrame:
    """Locator queries that differ from the category query, one per image and text."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "category_query", "locator_query")
    differ = e.filter(F.lower(F.trim("locator_query")) != F.lower(F.trim(F.coalesce("category_query", F.lit("")))))
    return R.first_per_key(differ, ["image_id", "locator_query"], [F.col("rank"), F.col("entity_id")]).select("image_id", "locator_query", "entity_id", "rank")


def fanout_entities(spark: SparkSession, d: str) -> DataFrame:
    """Regions attached to every grounder and query type that supports them."""
    g = table(spark, d, "grounded_entities", "region_id", "recorded_at", "ingested_at", "supporting_grounders", "query_types")
    one = R.first_per_key(g, ["region_id"], [F.desc("recorded_at"), F.desc("ingested_at")])
    return one.select("region_id", "query_types", F.explode("supporting_grounders").alias("grounder")).select("region_id", "grounder", F.explode("query_types").alias("query_type"))


def category_pool(spark: SparkSession, d: str) -> DataFrame:
    """Detections under their own key, and category detections once more under a pool of their category."""
    det = X.detections(spark, d)
    own = det.select("image_id", F.concat(F.lit("e"), F.col("det_no").cast("string")).alias("entity"), "det_no")
    pool = det.filter("query_type = 'category'").select("image_id", F.concat(F.lit("category_"), T.short_hash(F.lower("category"))).alias("entity"), "det_no")
    return own.unionByName(pool)


def manifest_join(spark: SparkSession, d: str) -> DataFrame:
    """Drafts with the size of their image; each image by its first delivery. Drafts without an image are left out."""
    m = table(spark, d, "manifest", "image_id", "image_path", "width", "height", "batch_no", "recorded_at", "ingested_at")
    keyed = m.withColumn("key", F.lower(F.trim("image_id")))
    one = R.first_per_key(keyed, ["key"], [F.col("batch_no"), F.col("recorded_at"), F.col("ingested_at")]).select("key", T.url_stem(F.col("image_path")).alias("stem"), "width", "height")
    drafts = table(spark, d, "expression_drafts", "expression_id", "image_id", "ingested_at").groupBy("expression_id", "image_id").agg(F.count("*").alias("copies"))
    return drafts.join(one, F.lower(F.trim("image_id")) == F.col("key")).select("expression_id", "copies", "stem", "width", "height")


def candidates_left(spark: SparkSession, d: str) -> DataFrame:
    """Every proposed entity with its regions; none for entities without."""
    e = table(spark, d, "entities", "image_id", "entity_id").distinct()
    g = table(spark, d, "grounded_entities", "image_id", "entity_id", "region_id").groupBy("image_id", "entity_id").agg(F.count_distinct("region_id").alias("n"), F.min("region_id").alias("first_region"))
    return e.join(g, ["image_id", "entity_id"], "left").select("image_id", "entity_id", F.coalesce("n", F.lit(0)).alias("regions"), "first_region")


def ocr_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Regions that have drafts with visible text but no such text among the image's proposals."""
    x = table(spark, d, "expression_drafts", "image_id", "region_id", "used_visible_text").filter(F.size("used_visible_text") > 0).select("image_id", "region_id").distinct()
    e = table(spark, d, "entities", "image_id", "visible_text").filter(F.size("visible_text") > 0).select("image_id").distinct()
    return x.join(e, "image_id", "left_anti")


def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    log = X.stage_log(spark, d)
    return R.pending(log.select("request_id", "image_id", "stage"), log.filter("committed"), ["request_id"])


def selected_semi(spark: SparkSession, d: str) -> DataFrame:
    """Proposals of the images chosen for the run that name a category."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "category").filter(F.trim(F.coalesce("category", F.lit(""))) != "")
    return e.join(table(spark, d, "route_b", "image_id"), "image_id", "left_semi").select("image_id", "entity_id", "rank").distinct()


def latest_revision(spark: SparkSession, d: str) -> DataFrame:
    """The latest attempt for each target; of repeated ones the first recorded."""
    x = table(spark, d, "expression_drafts", "base_expression_id", "expression_id", "revision", "recorded_at", "ingested_at")
    return R.latest_per_key(x, ["base_expression_id"], "revision", [F.col("recorded_at"), F.col("ingested_at"), F.col("expression_id")]).select("base_expression_id", "expression_id", "revision")


def _captions(spark: SparkSession, d: str) -> DataFrame:
    """Every image's caption by its first delivery."""
    m = table(spark, d, "manifest", "image_id", "caption", "batch_no", "recorded_at", "ingested_at").withColumn("key", F.lower(F.trim("image_id")))
    return R.first_per_key(m, ["key"], [F.col("batch_no"), F.col("recorded_at"), F.col("ingested_at"), F.col("caption")]).select(F.col("key").alias("image_id"), "caption")


def proposal_priority(spark: SparkSession, d: str) -> DataFrame:
    """Proposals without repeats, those whose span stands in the caption first, at most five per image, ranked anew."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "category", "caption_span", "caption_supported").distinct()
    span = T.supported_span(F.col("caption_span"), F.col("caption"))
    tidy = e.join(_captions(spark, d), "image_id").withColumn("span", F.when(F.col("caption_supported"), span).otherwise("")).withColumn("supported", F.col("span") != "")
    order = [F.col("rank"), F.col("entity_id")]
    once = R.first_per_key(tidy, ["image_id", "category", "span"], order)
    ranked = R.numbered(once.withColumnRenamed("rank", "model_rank"), ["image_id"], [F.desc("supported"), F.col("model_rank"), F.col("entity_id")], "rank")
    return ranked.filter("rank <= 5").select("image_id", "entity_id", F.col("rank").cast("int").alias("rank"), "model_rank", "supported", "span")


def instance_number(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col(c) for c in ("y1", "x1", "y2", "x2", "det_no")]
    n = R.numbered(X.detections(spark, d), ["image_id", "category"], order, "n")
    return n.select("image_id", "det_no", F.format_string("%s_i%02d", T.safe_id(F.col("category")), F.col("n")).alias("instance_id"))


def box_n_of_m(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("image_id")
    n = F.row_number().over(w.orderBy("det_no"))
    return X.detections(spark, d).select("image_id", "det_no", F.concat_ws(" of ", n.cast("string"), F.count("*").over(w).cast("string")).alias("label"))


def stage_phases(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive log rows of one stage of a user, folded."""
    p = R.islands(X.stage_log(spark, d), ["image_id"], [F.col("ts"), F.col("request_id")], "stage")
    return p.select("image_id", F.col("phase").cast("bigint").alias("phase"), "stage", "rows")


def peer_pages(spark: SparkSession, d: str) -> DataFrame:
    p = R.paged(X.detections(spark, d), ["image_id"], [F.col("det_no")], 3)
    return p.select("image_id", "det_no", "page", "page_place")


def counts_with_zeros(spark: SparkSession, d: str) -> DataFrame:
    """High-scored detections of every image, 0 where there are none."""
    return R.counts_with_zeros(X.sizes(spark, d), X.detections(spark, d).filter("score > 0.97"), ["image_id"])


def count_histogram(spark: SparkSession, d: str) -> DataFrame:
    return R.histogram(counts_with_zeros(spark, d), "n")


def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """Per stage what its answers cover; answers whose number five divides count as asked a second time."""
    log = X.stage_log(spark, d).select("stage", F.col("model_output_invalid").alias("invalid"), F.col("detections").alias("found"), (F.col("request_id") % 5 == 0).alias("rechecked"))
    return R.coverage(log, ["stage"]).withColumn("empty_share", F.round("empty_share", 9))


def stage_health(spark: SparkSession, d: str) -> DataFrame:
    """Per image and stage: answers, invalid ones, and a warning if all or at least five and a tenth of them are."""
    g = X.stage_log(spark, d).groupBy("image_id", "stage").agg(F.count("*").alias("answers"), F.count_if("model_output_invalid").alias("invalid"))
    alarm = (F.col("invalid") == F.col("answers")) | ((F.col("invalid") >= 5) & (F.col("invalid") * 10 >= F.col("answers")))
    return g.withColumn("warning", alarm)


def detector_map(spark: SparkSession, d: str) -> DataFrame:
    """Detections per detector of every image, as one text."""
    c = X.detections(spark, d).groupBy("image_id", "grounder").agg(F.count("*").alias("n"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("grounder", "n"))), lambda e: F.concat(e["grounder"], F.lit("="), e["n"].cast("string"))), ",")
    return c.groupBy("image_id").agg(listed.alias("counts"))


def shared_instances(spark: SparkSession, d: str) -> DataFrame:
    """Detections of exactly one geometry: the first one and all that refer to it."""
    g = X.detections(spark, d).groupBy("image_id", "x1", "y1", "x2", "y2")
    return g.agg(F.min("det_no").alias("first_det"), F.array_join(F.transform(F.sort_array(F.collect_list("det_no")), lambda v: v.cast("string")), ",").alias("members"))


def first_spelling(spark: SparkSession, d: str) -> DataFrame:
    """For every category, case and blanks aside, the spelling that came first and how many there are."""
    e = table(spark, d, "entities", "category", "recorded_at", "ingested_at", "image_id", "entity_id").filter("trim(category) <> ''")
    key = F.lower(F.trim("category"))
    order = F.struct("recorded_at", "ingested_at", "image_id", "entity_id", "category")
    return e.groupBy(key.alias("category_key")).agg(F.min_by("category", order).alias("first_spelling"), F.count_distinct("category").alias("spellings"))


def export_bag_diff(spark: SparkSession, d: str) -> DataFrame:
    """What a tampered export lacks or has too much of against its state."""
    state = X.expressions(spark, d).select("image_id", "det_no", "expression")
    export = state.filter("det_no % 11 <> 0").withColumn("expression", F.when(F.col("det_no") % 7 == 0, F.lit("edited")).otherwise(F.col("expression")))
    diff = R.bag_difference(state, export)
    return diff.select("image_id", "det_no", "expression", F.col("surplus_left").cast("bigint").alias("surplus_left"), F.col("surplus_right").cast("bigint").alias("surplus_right"))


def partition_check(spark: SparkSession, d: str) -> DataFrame:
    """Objects that are in neither or both of two exports."""
    det = X.detections(spark, d).select("image_id", "det_no")
    faults = R.partition_faults(det, [det.filter("det_no % 2 = 0 or det_no % 9 = 0"), det.filter("det_no % 2 = 1 and det_no % 5 <> 0")], ["image_id", "det_no"])
    return faults.select("image_id", "det_no", F.col("in_whole").cast("bigint").alias("in_whole"), F.col("in_parts").cast("bigint").alias("in_parts"))


def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    """Regions added or rescored between what had arrived by the end of April and all there is."""
    g = table(spark, d, "grounded_entities", "region_id", "recorded_at", "ingested_at", "grounder_support", "median_pairwise_iou", "mean_model_score")
    sign = R.signature_of("grounder_support", "median_pairwise_iou", "mean_model_score")
    last = lambda rows: R.first_per_key(rows, ["region_id"], [F.desc(c) for c in ("recorded_at", "ingested_at", "mean_model_score", "median_pairwise_iou")]).withColumn("s", sign)
    return R.changes(last(g.filter(F.col("ingested_at") < F.to_timestamp(F.lit("2025-05-01 00:00:00")))), last(g), ["region_id"], "s")


def cache_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Requests of a new run that a log of an older one answers: how many of its rows each takes over.

    In the older run some phrases differ, some requests' rows are not all there and some were made in another context.
    """
    det = X.detections(spark, d).select("image_id", "det_no", "category", (F.col("image_id") * 100 + F.col("det_no")).alias("request_id"))
    no = F.col("det_no")
    phrase = F.concat("category", F.lit(" "), no.cast("string"))
    sha = F.when(F.col("image_id") % 17 != 0, F.md5(F.col("image_id").cast("string")))
    requests = det.select("request_id", "image_id", phrase.alias("phrase"), sha.alias("sha"))
    old = det.select((-F.col("request_id")).alias("request_id"), "det_no", "image_id", F.when(no % 6 == 0, F.lit("other")).otherwise(phrase).alias("phrase"), sha.alias("sha"))
    progress = old.select("request_id", (1 + no % 3 + (no % 4 == 0).cast("int")).cast("bigint").alias("detections"), F.when(no % 9 == 0, "old").otherwise("now").alias("context"))
    rows = old.select("request_id", F.explode(F.sequence(F.lit(0), no % 3)).alias("detection_index"))
    kept = R.reconciled(requests, old.drop("det_no"), progress, rows, ["image_id", "phrase", "sha"], "now")
    return kept.groupBy("request_id").agg(F.count("*").alias("taken_over"), F.max("detection_index").alias("last_index"))


def partition_columns(spark: SparkSession, d: str) -> DataFrame:
    """Objects whose exported category or number is not that of the whole they are part of."""
    det = X.detections(spark, d).select("image_id", "det_no", "category", "grounder")
    part = det.withColumn("category", F.when(F.col("det_no") % 7 == 0, F.lit(None)).otherwise(F.col("category"))).withColumn("grounder", F.when(F.col("det_no") % 5 == 0, "edited").otherwise(F.col("grounder")))
    return R.column_faults(det, [part.filter("det_no % 2 = 0"), part.filter("det_no % 2 = 1")], ["image_id", "det_no"], ["category", "grounder"])


def stale_versions(spark: SparkSession, d: str) -> DataFrame:
    """Objects to be looked at again: their own number or the set of their category's others in the image has changed."""
    det = X.detections(spark, d).select("image_id", "category", "det_no", F.col("x1").alias("version"))
    before = det.filter("det_no % 8 <> 0").withColumn("version", F.when(F.col("det_no") == 3, -1.0).otherwise(F.col("version")))
    return R.stale(det, before, ["image_id", "category"], "det_no", "version").select("image_id", "category", "det_no")


def returned_peers(spark: SparkSession, d: str) -> DataFrame:
    """Objects whose answer names other peers than were asked for: some left out, some said twice, one foreign."""
    asked = X.comparisons(spark, d).select("image_id", "object_no", "peer_no")
    n = F.col("object_no") + F.col("peer_no")
    said = asked.filter(n % 7 != 0)
    returned = said.unionByName(said.filter(n % 11 == 0)).unionByName(asked.filter("object_no = 2").select("image_id", "object_no", F.lit(99).alias("peer_no")).distinct())
    return R.answer_faults(asked, returned, ["image_id", "object_no"], "peer_no")


def conflict_union(spark: SparkSession, d: str) -> DataFrame:
    """Peers that also match or that were declared competitors (here the next in number)."""
    c = X.comparisons(spark, d)
    declared = c.filter("peer_no = object_no + 1").select("image_id", "object_no", "peer_no")
    return R.conflict_ids(c, declared, ["image_id", "object_no"], "peer_no")


def drained_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Drafts tried again until they are good or the rounds are used up: each needs as many as its base's length tells."""
    x = table(spark, d, "expression_drafts", "base_expression_id").distinct().filter("base_expression_id is not null")
    state = x.select("base_expression_id", (F.length("base_expression_id") % 5).alias("needed"), F.lit(0).alias("revision"))
    pending = F.col("revision") < F.col("needed")
    done = R.drained(state, pending, lambda rows: rows.withColumn("revision", F.col("revision") + 1), max_rounds=2)
    return done.select("base_expression_id", "revision", (~pending).alias("accepted"))


def signature_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Inputs that must be computed again because their signature is not among the stored ones."""
    e = X.expressions(spark, d)
    inputs = e.select("image_id", "det_no", R.signature_of("expression", "revision").alias("signature"))
    stored = e.filter("det_no % 4 <> 1").select("image_id", "det_no", T.content_key(F.col("expression"), F.when(F.col("det_no") == 2, F.lit(9)).otherwise(F.col("revision"))).alias("signature"))
    return R.unchanged_and_stale(inputs, stored, ["image_id", "det_no"])[1].select("image_id", "det_no")


def lineage_filter(spark: SparkSession, d: str) -> DataFrame:
    """Later revisions whose base draft still reads as when they were made (its region unchanged)."""
    x = table(spark, d, "expression_drafts", "expression_id", "base_expression_id", "revision", "region_id").distinct()
    roots = x.filter("revision = 0").select("base_expression_id", F.sha1("region_id").alias("root")).distinct()
    return x.filter("revision > 0").withColumn("root", F.sha1("region_id")).join(roots, ["base_expression_id", "root"], "left_semi").select("expression_id", "revision")


def unique_and_contiguous(spark: SparkSession, d: str) -> DataFrame:
    """Images whose proposals have repeated ids (case aside) or gaps in their ranks, after some ids and ranks were spoilt."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank").distinct()
    spoilt = e.select("image_id", F.when(F.col("rank") == 4, F.upper("entity_id")).otherwise(F.col("entity_id")).alias("entity_id"), F.when(F.col("rank") == 6, 9).otherwise(F.col("rank")).alias("rank"))
    twice = e.filter("rank = 4").select("image_id", "entity_id", F.lit(4).alias("rank"))
    g = spoilt.unionByName(twice).groupBy("image_id").agg(F.count("*").alias("n"), F.count_distinct(F.lower("entity_id")).alias("ids"), F.count_distinct("rank").alias("ranks"), F.min("rank").alias("low"), F.max("rank").alias("high"))
    faults = (F.col("ids") < F.col("n")) | (F.col("ranks") < F.col("n")) | (F.col("low") != 1) | (F.col("high") != F.col("n"))
    return g.filter(faults).select("image_id", "n", "ids", "ranks", "low", "high")


def acceptance_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row over the whole delivery: regions, images, most regions of an image, largest share of an image."""
    g = R.first_per_key(table(spark, d, "grounded_entities", "region_id", "image_id", "bbox_area_ratio", "recorded_at", "ingested_at"), ["region_id"], [F.desc("recorded_at"), F.desc("ingested_at")])
    per = g.groupBy("image_id").agg(F.count("*").alias("n"), F.max("bbox_area_ratio").alias("largest"))
    return per.agg(F.sum("n").alias("regions"), F.count("*").alias("images"), F.max("n").alias("most_per_image"), F.max("largest").alias("largest_share"))


def integrity_report(spark: SparkSession, d: str) -> DataFrame:
    """Referential and key checks over the delivered tables: check, violations. Each check is one anti join or count."""
    m = table(spark, d, "manifest", "image_id").select(F.lower(F.trim("image_id")).alias("image_id"))
    e = table(spark, d, "entities", "image_id", "entity_id", "rank")
    g = table(spark, d, "grounded_entities", "region_id", "image_id", "entity_id", "grounder_support", "supporting_grounders", "size_pass", "size_reject_reason")
    x = table(spark, d, "expression_drafts", "expression_id", "base_expression_id", "region_id", "image_id", "revision", "previous_expression_id")
    r = table(spark, d, "route_b", "image_id")
    missing = lambda df, other, *keys: df.select(*keys).distinct().join(other.select(*keys).distinct(), list(keys), "left_anti")
    checks = {
        "entity_image_unknown": missing(e, m, "image_id"),
        "region_entity_unknown": missing(g, e, "image_id", "entity_id"),
        "draft_region_unknown": missing(x, g, "region_id"),
        "chosen_image_unknown": missing(r, m, "image_id"),
        "chosen_image_without_region": missing(r, g, "image_id"),
        "support_disagrees": g.filter(F.col("grounder_support") != F.size("supporting_grounders")),
        "size_reason_disagrees": g.filter(F.col("size_pass") == F.col("size_reject_reason").isNotNull()),
        "revision_without_predecessor": x.filter("revision > 0 and previous_expression_id is null"),
        "predecessor_unknown": x.filter("previous_expression_id is not null").select(F.col("previous_expression_id").alias("expression_id")).distinct().join(x.select("expression_id").distinct(), "expression_id", "left_anti"),
        "region_of_two_images": g.groupBy("region_id").agg(F.count_distinct("image_id").alias("n")).filter("n > 1"),
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = [integrity_report, box_metrics, clipped_boxes, normalized_region, crop_to_original, expand_view, unit_boxes, union_envelope, category_requests, request_members, locator_requests, fanout_entities, category_pool, manifest_join, candidates_left, ocr_completeness, resume_pending, selected_semi, latest_revision, proposal_priority, instance_number, box_n_of_m, stage_phases, peer_pages, counts_with_zeros, count_histogram, coverage_report, stage_health, detector_map, shared_instances, first_spelling, export_bag_diff, partition_check, snapshot_changes, cache_reconcile, partition_columns, stale_versions, returned_peers, conflict_union, drained_rounds, signature_reuse, lineage_filter, unique_and_contiguous, acceptance_summary]

_ZEROS = X.with_views("det", "size") + """, counted AS (SELECT image_id, count(*) AS n FROM det WHERE score > 0.97 GROUP BY 1),
  zeros AS (SELECT s.image_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT image_id FROM size) s LEFT JOIN counted c ON c.image_id = s.image_id)"""
_LATEST_REGION = "SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY recorded_at DESC NULLS LAST, ingested_at DESC NULLS LAST) AS r FROM grounded_entities QUALIFY r = 1"


def _expand_sql(lo: str, hi: str, whole: str) -> tuple[str, str]:
    size = f"least(CAST({whole} AS DOUBLE), greatest(({hi} - {lo}) * 3.0, {whole} * 0.15))"
    start = f"greatest(0.0, least({whole} - {size}, ({lo} + {hi}) / 2 - {size} / 2))"
    return f"floor({start})", f"ceil({start} + {size})"


_EX, _EY = _expand_sql("x1", "x2", "width"), _expand_sql("y1", "y2", "height")
_SIGN = "concat_ws('|', coalesce(length(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '~'), coalesce(length(CAST({1} AS VARCHAR)) || ':' || CAST({1} AS VARCHAR), '~'))"

SQL = {
    "integrity_report": """WITH m AS (SELECT DISTINCT lower(trim(image_id, ' ')) AS image_id FROM manifest)
SELECT 'entity_image_unknown' AS "check", count(*) AS violations FROM (SELECT DISTINCT image_id FROM entities EXCEPT SELECT image_id FROM m)
UNION ALL SELECT 'region_entity_unknown', count(*) FROM (SELECT image_id, entity_id FROM grounded_entities EXCEPT SELECT image_id, entity_id FROM entities)
UNION ALL SELECT 'draft_region_unknown', count(*) FROM (SELECT region_id FROM expression_drafts EXCEPT SELECT region_id FROM grounded_entities)
UNION ALL SELECT 'chosen_image_unknown', count(*) FROM (SELECT image_id FROM route_b EXCEPT SELECT image_id FROM m)
UNION ALL SELECT 'chosen_image_without_region', count(*) FROM (SELECT image_id FROM route_b EXCEPT SELECT image_id FROM grounded_entities)
UNION ALL SELECT 'support_disagrees', count(*) FROM grounded_entities WHERE grounder_support <> len(supporting_grounders)
UNION ALL SELECT 'size_reason_disagrees', count(*) FROM grounded_entities WHERE size_pass = (size_reject_reason IS NOT NULL)
UNION ALL SELECT 'revision_without_predecessor', count(*) FROM expression_drafts WHERE revision > 0 AND previous_expression_id IS NULL
UNION ALL SELECT 'predecessor_unknown', count(*) FROM (SELECT previous_expression_id FROM expression_drafts WHERE previous_expression_id IS NOT NULL EXCEPT SELECT expression_id FROM expression_drafts)
UNION ALL SELECT 'region_of_two_images', count(*) FROM (SELECT region_id FROM grounded_entities GROUP BY 1 HAVING count(DISTINCT image_id) > 1)""",
    "box_metrics": X.with_views("det", "size") + f"""
SELECT a.image_id, a.det_no, {X.area('a')} AS area, {X.area('a')} / CAST(width * height AS DOUBLE) AS area_ratio, {X.iou('a', 'b')} AS iou, {X.containment('a', 'b')} AS contained,
  greatest(abs((a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2) / least(a.x2 - a.x1, b.x2 - b.x1), abs((a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2) / least(a.y2 - a.y1, b.y2 - b.y1)) AS center_offset
FROM det a JOIN det b ON a.image_id = b.image_id AND b.det_no = 1 JOIN size s ON s.image_id = a.image_id""",
    "clipped_boxes": X.with_views("det", "size") + """, c AS (SELECT d.image_id, det_no, width, height, greatest(0.0, least(x1 * 12, width)) AS x1, greatest(0.0, least(y1 * 9, height)) AS y1,
    greatest(0.0, least(x2 * 12, width)) AS x2, greatest(0.0, least(y2 * 9, height)) AS y2 FROM det d JOIN size s ON s.image_id = d.image_id)
SELECT image_id, det_no, x1, y1, x2, y2, x1 >= 0 AND x1 < x2 AND x2 <= width AND y1 >= 0 AND y1 < y2 AND y2 <= height AND x2 - x1 >= 1 AND y2 - y1 >= 1 AS valid FROM c""",
    "normalized_region": X.with_views("det", "size") + """, r AS (SELECT d.image_id, det_no, width, height, x1 * 10 AS x1, y1 * 10 AS y1, x2 * 11 AS x2, y2 * 11 AS y2 FROM det d JOIN size s ON s.image_id = d.image_id),
  p AS (SELECT *, x1 < x2 AND x2 <= 1000 AND y1 < y2 AND y2 <= 1000 AS ok, floor(greatest(0.0, x1 - (x2 - x1) * 0.2) * width / 1000) AS a, floor(greatest(0.0, y1 - (y2 - y1) * 0.2) * height / 1000) AS b,
    ceil(least(1000.0, x2 + (x2 - x1) * 0.2) * width / 1000) AS c, ceil(least(1000.0, y2 + (y2 - y1) * 0.2) * height / 1000) AS e FROM r)
SELECT image_id, det_no, CASE WHEN ok THEN a END AS px1, CASE WHEN ok THEN b END AS py1, CASE WHEN ok THEN c END AS px2, CASE WHEN ok THEN e END AS py2 FROM p""",
    "crop_to_original": X.with_views("det") + """
SELECT image_id, det_no, 100 + x1 * 200 / 100 AS ox1, 50 + y1 * 300 / 200 AS oy1, 100 + x2 * 200 / 100 AS ox2, 50 + y2 * 300 / 200 AS oy2 FROM det""",
    "expand_view": X.with_views("det", "size") + f"""
SELECT d.image_id, det_no, {_EX[0]} AS ex1, {_EY[0]} AS ey1, {_EX[1]} AS ex2, {_EY[1]} AS ey2,
  floor(greatest(0.0, least(x1 - (x2 - x1) * 0.2, width))) AS px1, floor(greatest(0.0, least(y1 - (y2 - y1) * 0.2, height))) AS py1,
  ceil(greatest(0.0, least(x2 + (x2 - x1) * 0.2, width))) AS px2, ceil(greatest(0.0, least(y2 + (y2 - y1) * 0.2, height))) AS py2 FROM det d JOIN size s ON s.image_id = d.image_id""",
    "unit_boxes": X.with_views("det", "size") + """, u AS (SELECT d.image_id, det_no, width AS iw, height AS ih, x1 / 128 AS x, y1 / 128 AS y, (x2 - x1) / 256 AS w, (y2 - y1) / 256 AS h FROM det d JOIN size s ON s.image_id = d.image_id)
SELECT image_id, det_no, round(x * iw, 6) AS ax1, round(y * ih, 6) AS ay1, round((x + w) * iw, 6) AS ax2, round((y + h) * ih, 6) AS ay2,
  round((x - w / 2) * iw, 6) AS cx1, round((y - h / 2) * ih, 6) AS cy1, round((x + w / 2) * iw, 6) AS cx2, round((y + h / 2) * ih, 6) AS cy2 FROM u""",
    "union_envelope": X.with_views("det") + " SELECT image_id, category, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM det GROUP BY ALL",
    "category_requests": """SELECT image_id, lower(category_query) AS query, min(rank) AS rank, count(DISTINCT entity_id) AS entities, count(DISTINCT category) AS spellings,
  arg_min(entity_id, ROW(rank, entity_id)) AS first_entity, substr(sha1(lower(category_query)), 1, 12) AS suffix FROM entities WHERE category_query IS NOT NULL GROUP BY 1, 2""",
    "request_members": "SELECT DISTINCT image_id, lower(category_query) AS query, entity_id FROM entities WHERE category_query IS NOT NULL",
    "locator_requests": """SELECT image_id, locator_query, entity_id, rank FROM entities WHERE lower(trim(locator_query)) <> lower(trim(coalesce(category_query, '')))
QUALIFY row_number() OVER (PARTITION BY image_id, locator_query ORDER BY rank, entity_id) = 1""",
    "fanout_entities": f"""WITH one AS ({_LATEST_REGION}), g AS (SELECT region_id, query_types, unnest(supporting_grounders) AS grounder FROM one)
SELECT region_id, grounder, unnest(query_types) AS query_type FROM g""",
    "category_pool": X.with_views("det") + """ SELECT image_id, 'e' || det_no AS entity, det_no FROM det
UNION ALL SELECT image_id, 'category_' || substr(sha1(lower(category)), 1, 12), det_no FROM det WHERE query_type = 'category'""",
    "manifest_join": """WITH one AS (SELECT lower(trim(image_id)) AS key, regexp_extract(image_path, '([^/]*?)(\\.[^./]*)?$', 1) AS stem, width, height FROM manifest
  QUALIFY row_number() OVER (PARTITION BY lower(trim(image_id)) ORDER BY batch_no NULLS FIRST, recorded_at NULLS FIRST, ingested_at NULLS FIRST) = 1)
SELECT expression_id, count(*) AS copies, stem, width, height FROM expression_drafts x JOIN one ON lower(trim(x.image_id)) = key GROUP BY expression_id, image_id, stem, width, height""",
    "candidates_left": """SELECT e.image_id, e.entity_id, count(DISTINCT region_id) AS regions, min(region_id) AS first_region
FROM (SELECT DISTINCT image_id, entity_id FROM entities) e LEFT JOIN grounded_entities g ON g.image_id = e.image_id AND g.entity_id = e.entity_id GROUP BY 1, 2""",
    "ocr_completeness": """SELECT DISTINCT image_id, region_id FROM expression_drafts WHERE len(used_visible_text) > 0
AND image_id NOT IN (SELECT image_id FROM entities WHERE len(visible_text) > 0 AND image_id IS NOT NULL)""",
    "resume_pending": X.with_views("log") + " SELECT request_id, image_id, stage FROM log WHERE request_id NOT IN (SELECT request_id FROM log WHERE committed)",
    "selected_semi": "SELECT DISTINCT image_id, entity_id, rank FROM entities WHERE trim(category, ' ') <> '' AND image_id IN (SELECT image_id FROM route_b)",
    "latest_revision": """SELECT base_expression_id, expression_id, revision FROM expression_drafts
QUALIFY row_number() OVER (PARTITION BY base_expression_id ORDER BY revision DESC NULLS LAST, recorded_at NULLS FIRST, ingested_at NULLS FIRST, expression_id) = 1""",
    "proposal_priority": """WITH cap AS (SELECT lower(trim(image_id, ' ')) AS image_id, caption FROM manifest
    QUALIFY row_number() OVER (PARTITION BY lower(trim(image_id, ' ')) ORDER BY batch_no NULLS FIRST, recorded_at NULLS FIRST, ingested_at NULLS FIRST, caption NULLS FIRST) = 1),
  t AS (SELECT e.*, CASE WHEN caption_supported AND coalesce(contains(caption, caption_span), FALSE) THEN caption_span ELSE '' END AS span
    FROM (SELECT DISTINCT image_id, entity_id, rank, category, caption_span, caption_supported FROM entities) e JOIN cap USING (image_id)),
  once AS (SELECT *, span <> '' AS supported FROM t QUALIFY row_number() OVER (PARTITION BY image_id, category, span ORDER BY rank NULLS FIRST, entity_id NULLS FIRST) = 1)
SELECT image_id, entity_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY supported DESC, once.rank NULLS FIRST, entity_id NULLS FIRST) AS INT) AS rank, once.rank AS model_rank, supported, span
FROM once QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY supported DESC, once.rank NULLS FIRST, entity_id NULLS FIRST) <= 5""",
    "instance_number": X.with_views("det") + """
SELECT image_id, det_no, category || '_i' || lpad(CAST(row_number() OVER (PARTITION BY image_id, category ORDER BY y1, x1, y2, x2, det_no) AS VARCHAR), 2, '0') AS instance_id FROM det""",
    "box_n_of_m": X.with_views("det") + " SELECT image_id, det_no, row_number() OVER (PARTITION BY image_id ORDER BY det_no) || ' of ' || count(*) OVER (PARTITION BY image_id) AS label FROM det",
    "stage_phases": X.with_views("log") + """, n AS (SELECT *, CASE WHEN lag(stage) OVER w IS NOT DISTINCT FROM stage AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh FROM log WINDOW w AS (PARTITION BY image_id ORDER BY ts, request_id)),
  p AS (SELECT *, sum(fresh) OVER (PARTITION BY image_id ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING) AS phase FROM n)
SELECT image_id, CAST(phase AS BIGINT) AS phase, min(stage) AS stage, count(*) AS rows FROM p GROUP BY 1, 2""",
    "peer_pages": X.with_views("det") + """, n AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY det_no) - 1 AS k FROM det)
SELECT image_id, det_no, CAST(k // 3 AS INT) AS page, CAST(k % 3 + 1 AS INT) AS page_place FROM n""",
    "counts_with_zeros": _ZEROS + " SELECT * FROM zeros",
    "count_histogram": _ZEROS + " SELECT n, count(*) AS groups FROM zeros GROUP BY n",
    "coverage_report": X.with_views("log") + """, g AS (SELECT stage, count(*) AS total, count(*) FILTER (WHERE NOT model_output_invalid) AS valid, count(*) FILTER (WHERE model_output_invalid) AS invalid,
    count(*) FILTER (WHERE NOT model_output_invalid AND detections = 0) AS empty, CAST(coalesce(sum(detections) FILTER (WHERE NOT model_output_invalid), 0) AS BIGINT) AS proposals,
    count(*) FILTER (WHERE NOT model_output_invalid AND request_id % 5 = 0) AS rechecked, count(*) FILTER (WHERE NOT model_output_invalid AND request_id % 5 = 0 AND detections > 0) AS recovered FROM log GROUP BY 1),
  n AS (SELECT stage, detections, count(*) AS c FROM log WHERE NOT model_output_invalid GROUP BY 1, 2),
  l AS (SELECT stage, string_agg(detections || ':' || c, ',' ORDER BY detections) AS distribution FROM n GROUP BY 1)
SELECT g.*, round(empty / nullif(valid, 0), 9) AS empty_share, coalesce(distribution, '') AS distribution,
  valid > 0 AND (empty = valid OR (valid >= 10 AND empty * 2 >= valid)) AS warning FROM g LEFT JOIN l USING (stage)""",
    "stage_health": X.with_views("log") + """, g AS (SELECT image_id, stage, count(*) AS answers, count(*) FILTER (WHERE model_output_invalid) AS invalid FROM log GROUP BY 1, 2)
SELECT *, invalid = answers OR (invalid >= 5 AND invalid * 10 >= answers) AS warning FROM g""",
    "detector_map": X.with_views("det") + """, c AS (SELECT image_id, grounder, count(*) AS n FROM det GROUP BY 1, 2)
SELECT image_id, string_agg(grounder || '=' || n, ',' ORDER BY grounder) AS counts FROM c GROUP BY 1""",
    "shared_instances": X.with_views("det") + " SELECT image_id, x1, y1, x2, y2, min(det_no) AS first_det, string_agg(CAST(det_no AS VARCHAR), ',' ORDER BY det_no) AS members FROM det GROUP BY 1, 2, 3, 4, 5",
    "first_spelling": """SELECT lower(trim(category, ' ')) AS category_key, arg_min(category, ROW(recorded_at, ingested_at, image_id, entity_id, category)) AS first_spelling, count(DISTINCT category) AS spellings
FROM entities WHERE trim(category, ' ') <> '' GROUP BY 1""",
    "export_bag_diff": X.with_views("expr") + """, state AS (SELECT image_id, det_no, expression, 1 AS s FROM expr),
  export AS (SELECT image_id, det_no, CASE WHEN det_no % 7 = 0 THEN 'edited' ELSE expression END, -1 FROM expr WHERE det_no % 11 <> 0),
  net AS (SELECT image_id, det_no, expression, sum(s) AS n FROM (SELECT * FROM state UNION ALL SELECT * FROM export) GROUP BY 1, 2, 3 HAVING sum(s) <> 0)
SELECT image_id, det_no, expression, CAST(greatest(n, 0) AS BIGINT) AS surplus_left, CAST(greatest(-n, 0) AS BIGINT) AS surplus_right FROM net""",
    "partition_check": X.with_views("det") + """, t AS (SELECT image_id, det_no, 1 AS w, 0 AS p FROM det UNION ALL SELECT image_id, det_no, 0, 1 FROM det WHERE det_no % 2 = 0 OR det_no % 9 = 0
    UNION ALL SELECT image_id, det_no, 0, 1 FROM det WHERE det_no % 2 = 1 AND det_no % 5 <> 0)
SELECT image_id, det_no, CAST(sum(w) AS BIGINT) AS in_whole, CAST(sum(p) AS BIGINT) AS in_parts FROM t GROUP BY 1, 2 HAVING sum(w) <> 1 OR sum(p) <> 1""",
    "snapshot_changes": """WITH o AS (SELECT * FROM grounded_entities WHERE ingested_at < TIMESTAMPTZ '2025-05-01 00:00:00+00'
    QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY recorded_at DESC NULLS LAST, ingested_at DESC NULLS LAST, mean_model_score DESC NULLS LAST, median_pairwise_iou DESC NULLS LAST) = 1),
  n AS (SELECT * FROM grounded_entities
    QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY recorded_at DESC NULLS LAST, ingested_at DESC NULLS LAST, mean_model_score DESC NULLS LAST, median_pairwise_iou DESC NULLS LAST) = 1),
  j AS (SELECT coalesce(o.region_id, n.region_id) AS region_id, CASE WHEN o.region_id IS NULL THEN 'added' WHEN n.region_id IS NULL THEN 'removed'
    WHEN o.grounder_support IS DISTINCT FROM n.grounder_support OR o.median_pairwise_iou IS DISTINCT FROM n.median_pairwise_iou OR o.mean_model_score IS DISTINCT FROM n.mean_model_score THEN 'changed' END AS change
    FROM o FULL JOIN n ON o.region_id = n.region_id)
SELECT * FROM j WHERE change IS NOT NULL""",
    "cache_reconcile": X.with_views("det") + """ SELECT image_id * 100 + det_no AS request_id, CAST(1 + det_no % 3 AS BIGINT) AS taken_over, CAST(det_no % 3 AS INT) AS last_index
FROM det WHERE image_id % 17 <> 0 AND det_no % 6 <> 0 AND det_no % 4 <> 0 AND det_no % 9 <> 0""",
    "partition_columns": X.with_views("det") + """ SELECT image_id, det_no, concat_ws(',', CASE WHEN det_no % 7 = 0 THEN 'category' END, CASE WHEN det_no % 5 = 0 THEN 'grounder' END) AS differing
FROM det WHERE det_no % 7 = 0 OR det_no % 5 = 0""",
    "stale_versions": X.with_views("det") + """ SELECT a.image_id, a.category, a.det_no FROM det a WHERE EXISTS (SELECT 1 FROM det b WHERE b.image_id = a.image_id AND b.category = a.category AND (b.det_no % 8 = 0 OR b.det_no = 3))""",
    "returned_peers": X.with_views("comp") + """ SELECT image_id, object_no, count(*) FILTER (WHERE (object_no + peer_no) % 7 = 0) AS missing, CASE WHEN object_no = 2 THEN 1 ELSE 0 END::BIGINT AS foreign,
  count(*) FILTER (WHERE (object_no + peer_no) % 7 <> 0 AND (object_no + peer_no) % 11 = 0) AS repeated,
  object_no <> 2 AND count(*) FILTER (WHERE (object_no + peer_no) % 7 = 0 OR (object_no + peer_no) % 11 = 0) = 0 AS complete FROM comp GROUP BY 1, 2""",
    "conflict_union": X.with_views("comp") + " SELECT DISTINCT image_id, object_no, peer_no FROM comp WHERE also_matches OR peer_no = object_no + 1",
    "drained_rounds": """SELECT DISTINCT base_expression_id, CAST(least(length(base_expression_id) % 5, 3) AS INT) AS revision, length(base_expression_id) % 5 <= 3 AS accepted
FROM expression_drafts WHERE base_expression_id IS NOT NULL""",
    "signature_reuse": X.with_views("expr") + f""", i AS (SELECT image_id, det_no, {_SIGN.format('expression', 'revision')} AS s FROM expr),
  k AS (SELECT image_id, det_no, {_SIGN.format('expression', '(CASE WHEN det_no = 2 THEN 9 ELSE revision END)')} AS s FROM expr WHERE det_no % 4 <> 1)
SELECT image_id, det_no FROM i WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.image_id = i.image_id AND k.det_no = i.det_no AND k.s = i.s)""",
    "lineage_filter": """WITH x AS (SELECT DISTINCT expression_id, base_expression_id, revision, region_id FROM expression_drafts)
SELECT expression_id, revision FROM x WHERE revision > 0 AND EXISTS (SELECT 1 FROM x r WHERE r.revision = 0 AND r.base_expression_id = x.base_expression_id AND r.region_id = x.region_id)""",
    "unique_and_contiguous": """WITH e AS (SELECT DISTINCT image_id, entity_id, rank FROM entities),
  s AS (SELECT image_id, CASE WHEN rank = 4 THEN upper(entity_id) ELSE entity_id END AS entity_id, CASE WHEN rank = 6 THEN 9 ELSE rank END AS rank FROM e
    UNION ALL SELECT image_id, entity_id, 4 FROM e WHERE rank = 4),
  g AS (SELECT image_id, count(*) AS n, count(DISTINCT lower(entity_id)) AS ids, count(DISTINCT rank) AS ranks, min(rank) AS low, max(rank) AS high FROM s GROUP BY 1)
SELECT * FROM g WHERE ids < n OR ranks < n OR low <> 1 OR high <> n""",
    "acceptance_summary": f"""WITH g AS ({_LATEST_REGION}), p AS (SELECT image_id, count(*) AS n, max(bbox_area_ratio) AS largest FROM g GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS regions, count(*) AS images, max(n) AS most_per_image, max(largest) AS largest_share FROM p""",
}
