"""Queries of phrases, evidence, budgets and model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.functions import text as T
from sightline.operators import inference
from sightline.operators import relational as R
from sightline.plans import fixtures as X
from sightline.sources import table


def _drafts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Drafts without their repeated rows: of each id the row that arrived first."""
    x = table(spark, d, "expression_drafts", "expression_id", "ingested_at", *columns)
    return R.first_per_key(x, ["expression_id"], [F.col("ingested_at"), *[F.col(c) for c in columns if c in ("expression", "head_category")]])


def phrase_lint(spark: SparkSession, d: str) -> DataFrame:
    """Error codes of every draft; images with more than one region count as having distractors."""
    x = _drafts(spark, d, "image_id", "region_id", "expression", "used_attributes", "used_action", "used_relation", "used_visible_text", "comparison_basis")
    regions = table(spark, d, "grounded_entities", "image_id", "region_id").groupBy("image_id").agg((F.count_distinct("region_id") - 1).alias("distractors"))
    j = x.join(regions, "image_id", "left").withColumn("distractors", F.coalesce("distractors", F.lit(0)))
    errors = T.phrase_errors(F.col("expression"), F.col("used_attributes"), F.col("used_action"), F.col("used_relation"), F.col("used_visible_text"), F.col("comparison_basis"), F.col("distractors"))
    return j.select("expression_id", F.array_join(errors, ",").alias("errors"), T.word_count(T.collapse(F.col("expression"))).cast("bigint").alias("words"))


def evidence_subset(spark: SparkSession, d: str) -> DataFrame:
    """Drafts and how many of their used attributes and texts (case aside) were not proposed for their image."""
    x = _drafts(spark, d, "image_id", "used_attributes", "used_visible_text")
    e = table(spark, d, "entities", "image_id", "attributes", "visible_text")
    said = lambda df, a, v: df.select("*", F.explode(F.transform(a, lambda t: F.struct(F.lit("a").alias("kind"), t.alias("t")))).alias("f")).unionByName(df.select("*", F.explode(F.transform(v, lambda t: F.struct(F.lit("v").alias("kind"), F.lower(t).alias("t")))).alias("f")))
    used = said(x, "used_attributes", "used_visible_text").select("expression_id", "image_id", F.col("f.kind").alias("kind"), F.col("f.t").alias("t")).distinct()
    pool = said(e, "attributes", "visible_text").select("image_id", F.col("f.kind").alias("kind"), F.col("f.t").alias("t")).distinct()
    missing = used.join(pool, ["image_id", "kind", "t"], "left_anti").groupBy("expression_id").agg(F.count_if(F.col("kind") == "a").alias("ma"), F.count_if(F.col("kind") == "v").alias("mv"))
    j = x.join(missing, "expression_id", "left")
    ma, mv = F.coalesce("ma", F.lit(0)), F.coalesce("mv", F.lit(0))
    return j.select("expression_id", ma.alias("missing_attributes"), mv.alias("missing_texts"), ((ma == 0) & (mv == 0)).alias("supported"))


def phrase_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Phrases (case and blanks aside) that stand for several objects of one image."""
    x = X.expressions(spark, d).select("image_id", "det_no", T.fold(F.col("expression")).alias("phrase")).filter("phrase <> ''")
    groups = x.groupBy("image_id", "phrase").agg(F.count("*").alias("objects")).filter("objects > 1")
    return x.join(groups, ["image_id", "phrase"]).select("image_id", "det_no", "phrase", "objects")


def review_index(spark: SparkSession, d: str) -> DataFrame:
    """One line per draft for reviewers: its place among its image's, and its evidence."""
    x = _drafts(spark, d, "image_id", "used_attributes", "used_action", "used_relation", "used_visible_text")
    one = lambda c: F.array(F.nullif(F.col(c), F.lit("")))
    evidence = T.evidence_line(F.col("used_attributes"), one("used_action"), one("used_relation"), F.col("used_visible_text"))
    return R.numbered_spread(x, ["image_id"], [F.col("expression_id")], "n").select("expression_id", F.col("n").cast("int").alias("place"), evidence.alias("evidence"))


def finalize_cap(spark: SparkSession, d: str) -> DataFrame:
    """The latest attempts of every image in quality order, the first thirty kept, the rest with their reason."""
    x = _drafts(spark, d, "image_id", "base_expression_id", "revision", "used_attributes")
    last = R.latest_per_key(x, ["base_expression_id"], "revision", [F.col("ingested_at"), F.col("expression_id")])
    quality = F.size("used_attributes")
    return R.capped(last, ["image_id"], [quality.desc(), F.asc("revision"), F.asc("expression_id")], 30).select("expression_id", F.col("place").cast("int").alias("place"), "kept", "reject_reason")


def comparison_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Worst outcome of each object's three-valued comparisons: a match is worst, then an unknown, then none."""
    c = X.comparisons(spark, d)
    rank = F.when(F.col("also_matches"), 0).when(F.col("also_matches").isNull(), 1).otherwise(2)
    g = c.groupBy("image_id", "object_no").agg(F.min(rank).alias("worst"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("also_matches"), F.col("peer_no")))), lambda v: v.cast("string")), ",").alias("conflicts"))
    return g.select("image_id", "object_no", F.element_at(F.array(F.lit("matches_others"), F.lit("unknown"), F.lit("unique")), F.col("worst") + 1).alias("outcome"), "conflicts")


def budget_reserve(spark: SparkSession, d: str) -> DataFrame:
    """The hint each category searches next: one that runs keeps its slot, else the first pending one within two slots."""
    h = X.hints(spark, d)
    w = Window.partitionBy("image_id", "category")
    used = F.count_if(F.col("status") != "pending").over(w)
    running = F.min(F.when(F.col("status") == "running", F.col("hint_no"))).over(w)
    first = F.min(F.when(F.col("status") == "pending", F.col("hint_no"))).over(w)
    return h.withColumn("next", F.coalesce(running, F.when(used < 2, first))).filter("hint_no = next").select("image_id", "category", "hint_no", "status")


def search_audit(spark: SparkSession, d: str) -> DataFrame:
    g = X.hints(spark, d).groupBy("image_id", "category").agg(F.count("*").alias("searches"), F.count_if(F.col("status") != "pending").alias("used"), F.count_if(F.col("status") != "done").alias("open"))
    return g.withColumn("stop_reason", F.when(F.col("open") > 0, "budget_exhausted").otherwise("no_pending_evidence"))


def safe_ids(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of every spelling of a category, with its hash."""
    c = table(spark, d, "entities", "category").filter("category is not null").distinct()
    return c.select("category", T.safe_id(F.col("category")).alias("safe"), T.short_hash(F.col("category")).alias("suffix"))


def json_answers(spark: SparkSession, d: str) -> DataFrame:
    """Model answers as text, and the object read from each: in a fence, after other words, or none."""
    e = table(spark, d, "entities", "image_id", "entity_id", "rank", "action").distinct()
    body = F.concat(F.lit('{"rank": '), F.col("rank").cast("string"), F.lit(', "action": "'), F.coalesce("action", F.lit("")), F.lit('"}'))
    answer = F.when(F.col("rank") % 3 == 0, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```"))).when(F.col("rank") % 3 == 1, F.concat(F.lit("The answer is "), body, F.lit(" as asked."))).otherwise(F.lit("no object here"))
    found = e.withColumn("object", T.json_object_text(answer))
    parsed = F.from_json("object", "rank int, action string")
    return found.select("image_id", "entity_id", parsed["rank"].alias("read_rank"), F.nullif(parsed["action"], F.lit("")).alias("read_action"))


def text_box_parse(spark: SparkSession, d: str) -> DataFrame:
    """Boxes read from free answers in ten forms, in pixels: agreeing, differing, faulty, nested, behind and in thoughts."""
    det = X.detections(spark, d).join(X.sizes(spark, d), "image_id")
    shown = lambda k, more="": F.concat(F.lit("["), F.concat_ws(", ", *[(F.col(c) + k).cast("string") for c in ("x1", "y1", "x2", "y2")]), F.lit(more + "]"))
    said = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    forms = [
        said("I see ", shown(0), " and ", shown(5)),
        said("<think>maybe ", shown(7), '</think>{"box": ', shown(0), "}"),
        shown(0),
        said("<think>", shown(0)),
        said(shown(0), " or [-1, 2, 3, 4]"),
        said('{"bbox_2d": ', shown(0, ", 5"), ', "x": ', shown(0), "}"),
        said(shown(0), ", that is ", shown(0), " {not json"),
        F.lit("no box"),
        F.lit("[1, 2, NaN, 4]"),
        said('{"answer": {"items": [true, {"box": "none", "bbox_2d": ', shown(0), "}]}}"),
    ]
    text = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        text = F.when(F.col("det_no") % 10 == k, form).otherwise(text)
    b = T.parsed_box(text, F.col("width"), F.col("height"))
    return det.select("image_id", "det_no", b.alias("b")).select("image_id", "det_no", *[F.round(F.get("b", k), 6).alias(f"b{k}") for k in range(4)])


def _size_model(batch):
    """A stand-in for a model: judges a category by the length of its name, and fails on some at first or for good."""
    from sightline.operators.inference import InvalidAnswer

    out = []
    for c, told in zip(batch["category"], batch["feedback"]):
        n = len(c)
        out.append(InvalidAnswer("too long") if n % 5 == 0 or (n % 5 == 1 and told is None) else {"letters": n, "even": n % 2 == 0})
    return out


def model_calls(spark: SparkSession, d: str) -> DataFrame:
    """Every proposal with a model's answer about its category; each distinct category is asked once."""
    e = table(spark, d, "entities", "image_id", "entity_id", "category").filter("category is not null").distinct()
    got = inference.call(e, ["category"], _size_model, "letters int, even boolean", {"letters": None, "even": False})
    return got.select("image_id", "entity_id", "category", "letters", "even", "attempts", "error")


def identity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """One key for each pair of compared objects, whichever way round they were compared."""
    c = X.comparisons(spark, d)
    pair = lambda n: F.concat_ws("/", F.col("image_id").cast("string"), F.col(n).cast("string"))
    keyed = c.select("image_id", pair("object_no").alias("a"), pair("peer_no").alias("b"), "also_matches").withColumn("k", inference.pair_key("a", "b"))
    g = keyed.groupBy("k").agg(F.min("image_id").alias("image_id"), F.count("*").alias("n"), F.count_distinct("a").alias("ends"))
    return g.groupBy("image_id").agg(F.count("*").alias("pairs"), F.sum("n").alias("comparisons"), F.max("ends").alias("ends"))


def truncated_texts(spark: SparkSession, d: str) -> DataFrame:
    """Raw answers cut to the lengths of the audit tables."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.substring("text", 1, 1200).alias("excerpt"), F.length("text").cast("bigint").alias("chars"))


QUERIES = [phrase_lint, evidence_subset, phrase_collisions, review_index, finalize_cap, comparison_outcome, budget_reserve, search_audit, safe_ids, json_answers, text_box_parse, model_calls, identity_pairs, truncated_texts]

_DRAFTS = "SELECT * FROM expression_drafts QUALIFY row_number() OVER (PARTITION BY expression_id ORDER BY ingested_at NULLS FIRST{}) = 1"
_TIDY = "trim(regexp_replace(coalesce(expression, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ')"
_ANNOTATION = " OR ".join(f"contains(lower(t), '{w}')" for w in T.ANNOTATION_WORDS)
_WORDS = "len(regexp_extract_all(t, '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)*'))"
_FOLD = "lower(trim(coalesce(expression, ''), ' '))"

SQL = {
    "phrase_lint": f"""WITH x AS ({_DRAFTS.format(', expression')}), r AS (SELECT image_id, count(DISTINCT region_id) - 1 AS others FROM grounded_entities GROUP BY 1),
  p AS (SELECT x.*, {_TIDY} AS t, coalesce(others, 0) AS others FROM x LEFT JOIN r ON r.image_id = x.image_id)
SELECT expression_id, concat_ws(',', CASE WHEN NOT (starts_with(t, 'the ') OR starts_with(t, 'The ')) THEN 'expression_must_start_with_the' END,
  CASE WHEN {_WORDS} < 8 OR {_WORDS} > 30 THEN 'expression_word_count_out_of_range' END, CASE WHEN {_ANNOTATION} THEN 'expression_mentions_annotation_or_image' END,
  CASE WHEN coalesce(len(used_attributes), 0) + CASE WHEN coalesce(used_action, '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(used_relation, '') <> '' THEN 1 ELSE 0 END + coalesce(len(used_visible_text), 0) < 2
    THEN 'insufficient_visible_discriminative_cues' END,
  CASE WHEN others > 0 AND coalesce(len(comparison_basis), 0) = 0 THEN 'missing_same_category_comparison' END,
  CASE WHEN len(list_filter(coalesce(used_visible_text, []), lambda v: NOT contains(lower(t), lower(v)))) > 0 THEN 'declared_visible_text_missing_from_expression' END) AS errors,
  {_WORDS} AS words FROM p""",
    "evidence_subset": f"""WITH x AS ({_DRAFTS.format('')}), ea AS (SELECT image_id, list(DISTINCT a) AS a FROM (SELECT image_id, unnest(attributes) AS a FROM entities) GROUP BY 1),
  ev AS (SELECT image_id, list(DISTINCT v) AS v FROM (SELECT image_id, lower(unnest(visible_text)) AS v FROM entities) GROUP BY 1),
  j AS (SELECT expression_id, len(list_filter(list_distinct(coalesce(used_attributes, [])), lambda q: NOT list_contains(coalesce(a, []), q))) AS ma,
    len(list_filter(list_distinct(list_transform(coalesce(used_visible_text, []), lambda q: lower(q))), lambda q: NOT list_contains(coalesce(v, []), q))) AS mv
    FROM x LEFT JOIN ea ON ea.image_id = x.image_id LEFT JOIN ev ON ev.image_id = x.image_id)
SELECT expression_id, CAST(ma AS BIGINT) AS missing_attributes, CAST(mv AS BIGINT) AS missing_texts, ma = 0 AND mv = 0 AS supported FROM j""",
    "phrase_collisions": X.with_views("expr") + f""", x AS (SELECT image_id, det_no, {_FOLD} AS phrase FROM expr)
SELECT image_id, det_no, phrase, count(*) OVER (PARTITION BY image_id, phrase) AS objects FROM x QUALIFY objects > 1""",
    "review_index": f"""WITH x AS ({_DRAFTS.format('')})
SELECT expression_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY expression_id) AS INT) AS place,
  array_to_string(list_filter(list_concat(coalesce(used_attributes, []), [nullif(used_action, '')], [nullif(used_relation, '')], coalesce(used_visible_text, [])), lambda v: v IS NOT NULL), ' | ') AS evidence FROM x""",
    "finalize_cap": f"""WITH x AS ({_DRAFTS.format('')}), l AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY base_expression_id ORDER BY revision DESC NULLS LAST, ingested_at NULLS FIRST, expression_id) = 1),
  n AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY coalesce(len(used_attributes), -1) DESC, revision NULLS FIRST, expression_id) AS k FROM l)
SELECT expression_id, CAST(k AS INT) AS place, k <= 30 AS kept, CASE WHEN k > 30 THEN 'per_source_cap' END AS reject_reason FROM n""",
    "comparison_outcome": X.with_views("comp") + """
SELECT image_id, object_no, CASE WHEN bool_or(also_matches) THEN 'matches_others' WHEN count(*) > count(also_matches) THEN 'unknown' ELSE 'unique' END AS outcome,
  coalesce(string_agg(CAST(peer_no AS VARCHAR), ',' ORDER BY peer_no) FILTER (WHERE also_matches), '') AS conflicts FROM comp GROUP BY 1, 2""",
    "budget_reserve": X.with_views("hint") + """, g AS (SELECT image_id, category, count(*) FILTER (WHERE status <> 'pending') AS used, min(hint_no) FILTER (WHERE status = 'running') AS running,
    min(hint_no) FILTER (WHERE status = 'pending') AS pending FROM hint GROUP BY 1, 2)
SELECT h.image_id, h.category, h.hint_no, h.status FROM hint h JOIN g ON g.image_id = h.image_id AND g.category = h.category AND h.hint_no = coalesce(running, CASE WHEN used < 2 THEN pending END)""",
    "search_audit": X.with_views("hint") + """, g AS (SELECT image_id, category, count(*) AS searches, count(*) FILTER (WHERE status <> 'pending') AS used, count(*) FILTER (WHERE status <> 'done') AS open FROM hint GROUP BY 1, 2)
SELECT *, CASE WHEN open > 0 THEN 'budget_exhausted' ELSE 'no_pending_evidence' END AS stop_reason FROM g""",
    "safe_ids": """SELECT DISTINCT category, coalesce(nullif(regexp_replace(regexp_replace(category, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'entity') AS safe,
  substr(sha1(category), 1, 12) AS suffix FROM entities WHERE category IS NOT NULL""",
    "json_answers": """SELECT DISTINCT image_id, entity_id, CASE WHEN rank % 3 <> 2 THEN rank END AS read_rank, CASE WHEN rank % 3 <> 2 THEN nullif(action, '') END AS read_action FROM entities""",
    "text_box_parse": X.with_views("det", "size") + """ SELECT d.image_id, det_no, CASE WHEN ok THEN round(x1 * width / 1000, 6) END AS b0, CASE WHEN ok THEN round(y1 * height / 1000, 6) END AS b1,
  CASE WHEN ok THEN round(x2 * width / 1000, 6) END AS b2, CASE WHEN ok THEN round(y2 * height / 1000, 6) END AS b3 FROM (SELECT *, det_no % 10 IN (1, 2, 6, 9) AS ok FROM det) d JOIN size s ON s.image_id = d.image_id""",
    "model_calls": """SELECT DISTINCT image_id, entity_id, category, CASE WHEN length(category) % 5 <> 0 THEN CAST(length(category) AS INT) END AS letters,
  length(category) % 5 <> 0 AND length(category) % 2 = 0 AS even, CASE length(category) % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN length(category) % 5 = 0 THEN 'too long' END AS error FROM entities WHERE category IS NOT NULL""",
    "identity_pairs": X.with_views("comp") + """, p AS (SELECT image_id, least(object_no, peer_no) AS lo, greatest(object_no, peer_no) AS hi, count(*) AS n, count(DISTINCT object_no) AS ends FROM comp GROUP BY 1, 2, 3)
SELECT image_id, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS comparisons, max(ends) AS ends FROM p GROUP BY 1""",
    "truncated_texts": "SELECT doc_id, substr(text, 1, 1200) AS excerpt, length(text) AS chars FROM documents",
}
