"""The subpackage's named queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import epoch_sample, leakage, mixing, repetition, sentences, term_counts, topn, truncation
from sightline.llm.common import caption_texts, spread
from sightline.session import scratch_path
from sightline.sources import table

SAMPLE_SEED = 20250101
SAMPLE_RATES = {0: 0.1}


def _texts(spark: SparkSession, d: str) -> DataFrame:
    manifest = table(spark, d, "manifest", "image_id", "dataset", "caption")
    return caption_texts(manifest, table(spark, d, "expression_drafts", "expression_id", "writer_model", "expression"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct text of a record with its share of repeated words and whether that is too much."""
    measured = repetition.shares(spread(_texts(spark, d)), "text")
    return measured.select("record_table", "record_id", "text", "repeated_share", (F.col("repeated_share") >= repetition.LIMIT).alias("repetitive")).distinct()


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.judge(spread(_texts(spark, d)), "text").filter("repetitive").select("record_table", "record_id").distinct()


def _regions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    grounded = table(spark, d, "grounded_entities", "region_id", "image_id", "grounder_support", "median_pairwise_iou", "recorded_at", "ingested_at")
    return grounded, table(spark, d, "route_b", "image_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.best_regions(*_regions(spark, d)).select("image_id", "place", "region_id")


def p2_skipping(spark: SparkSession, d: str) -> DataFrame:
    """How many row groups the search for the best regions read and skipped."""
    return topn.region_skipping(*_regions(spark, d))


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    """For every dataset and writer model how many of its texts there are and how many are cut; repeated rows count as they stand."""
    judged = truncation.score_all(spread(_texts(spark, d)), "record_table", "text")
    return judged.filter("text is not null").groupBy("record_table", "origin").agg(F.count("*").alias("texts"), F.sum(F.col("cut").cast("bigint")).alias("cut_texts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    judged = truncation.score_all(spread(_texts(spark, d)), "record_table", "text")
    return judged.filter("cut").select("record_table", "record_id").distinct()


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    """Every chosen image with its first delivery, frozen rate and draw, after the deliveries came in their order."""
    rows = table(spark, d, "manifest", "image_id", "batch_no")
    ledger = epoch_sample.replay(rows, "image_id", "batch_no", SAMPLE_RATES, scratch_path(spark, "ledger"))
    picked = epoch_sample.chosen(ledger, SAMPLE_SEED)
    return picked.select(F.col("key").alias("image_id"), "first_epoch", "rate", "draw")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    fields = (("entities", "category"), ("expression_drafts", "head_category"))
    parts = [table(spark, d, t, c, "image_id").select(F.lit(f"{t}.{c}").alias("field"), F.col(c).alias("value"), F.col("image_id").alias("record")) for t, c in fields]
    return term_counts.marked(term_counts.count_terms(parts[0].unionByName(parts[1])))


def p5_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct term with its counts and mark."""
    return _terms(spark, d).select(F.col("field").alias("field_name"), "term", "occurrences", "records", "mark")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).filter("mark is not null").select(F.col("field").alias("field_name"), "term", "mark")


def _documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return spread(table(spark, d, "documents", *columns))


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every leaked item with the longest exact run and the share of the passage that stands in order."""
    return leakage.find_leaks(_documents(spark, d, "doc_id", "text"), table(spark, d, "eval_items", "item_id", "passage"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_leaks(spark, d).select("doc_id", "item_id")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = mixing.sized(_documents(spark, d, "doc_id", "source", "lang", "text"))
    return sizes, mixing.fit(sizes, table(spark, d, "mix_targets"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Size, goal, tokens and share reached of every source of every mix."""
    return mixing.report(*_mix(spark, d))


def p7_members(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every mix with their uses."""
    return mixing.members(*_mix(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1].filter("short").select("mix_id", "source").distinct()


def p8_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence unit with its place and text."""
    return sentences.split_sentences(_documents(spark, d, "doc_id", "text"), "doc_id", "text", restore=True)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split_sentences(_documents(spark, d, "doc_id", "text"), "doc_id", "text").drop("place").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_shares, p1_found, p2_found, p2_skipping, p3_rates, p3_found, p4_sample, p5_terms, p5_found, p6_leaks, p6_found, p7_report, p7_members, p7_found, p8_sentences, p8_found)}


_P2 = """
WITH latest AS (
  SELECT region_id, image_id, grounder_support AS s,
         CASE WHEN isnan(median_pairwise_iou) THEN NULL ELSE median_pairwise_iou END AS m,
         row_number() OVER (PARTITION BY region_id ORDER BY recorded_at DESC NULLS LAST, ingested_at DESC NULLS LAST,
           grounder_support DESC NULLS LAST, median_pairwise_iou DESC NULLS LAST) AS r
  FROM grounded_entities WHERE region_id IS NOT NULL),
placed AS (
  SELECT image_id, region_id,
         CAST(row_number() OVER (PARTITION BY image_id ORDER BY s DESC NULLS LAST, m DESC NULLS LAST, region_id) AS INT) AS place
  FROM latest WHERE r = 1 AND image_id IN (SELECT image_id FROM route_b))
SELECT image_id, place, region_id FROM placed WHERE place <= 5
"""

_P4 = rf"""
WITH ledger AS (
  SELECT nullif(lower(regexp_replace(image_id, '^[\s\x{{a0}}\x{{200b}}\x{{feff}}]+|[\s\x{{a0}}\x{{200b}}\x{{feff}}]+$', '', 'g')), '') AS image_id,
         min(coalesce(batch_no, 2147483647)) AS first_epoch
  FROM manifest GROUP BY 1),
drawn AS (
  SELECT image_id, first_epoch, CAST(0.1 AS DOUBLE) AS rate,
         CAST(CAST('0x' || substr(md5('{SAMPLE_SEED}:0:' || image_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM ledger WHERE image_id IS NOT NULL)
SELECT image_id, first_epoch, rate, draw FROM drawn WHERE draw < rate
"""


_EDGE = r"^[\s\x{a0}\x{200b}\x{feff}]+|[\s\x{a0}\x{200b}\x{feff}]+$"

_P1 = rf"""
WITH texts AS (
  SELECT DISTINCT 'manifest' AS record_table, nullif(lower(regexp_replace(image_id, '{_EDGE}', '', 'g')), '') AS record_id, caption AS text FROM manifest
  UNION SELECT 'expression_drafts', expression_id, expression FROM expression_drafts),
worded AS (
  SELECT record_table, record_id, text, row_number() OVER () AS k, regexp_extract_all(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '<[^<>]*>|&#?[A-Za-z0-9]+;', ' ', 'g'),
    '[\p{{Cf}}\x{{34f}}\x{{fe00}}-\x{{fe0f}}]', '', 'g')), '\p{{N}}+(?:[.,:]\p{{N}}+)*', '0', 'g'), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM texts),
runs AS (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM worded),
again AS (SELECT k, i, i > min(i) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS later FROM runs),
hit AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM again WHERE later) GROUP BY k),
shares AS (SELECT record_table, record_id, text, CASE WHEN len(w) > 0 THEN coalesce(n, 0) / len(w) ELSE 0.0 END AS share FROM worded LEFT JOIN hit USING (k))
"""

# Of the compatibility forms only full-width letters and digits are written out; the tables hold no others.
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F) if chr(c).isalnum())
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c).isalnum())


def _term(column: str) -> str:
    plain = rf"regexp_replace(translate(nfc_normalize({column}), '{_WIDE}', '{_NARROW}'), '\p{{Cf}}', '', 'g')"
    return rf"nullif(lower(trim(regexp_replace({plain}, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]+', ' ', 'g'), ' ')), '')"


_P5 = f"""
WITH tokens AS (
  SELECT 'entities.category' AS field_name, {_term('category')} AS term, image_id FROM entities
  UNION ALL SELECT 'expression_drafts.head_category', {_term('head_category')}, image_id FROM expression_drafts),
whole AS (SELECT field_name, count(DISTINCT image_id) AS n FROM tokens WHERE term IS NOT NULL GROUP BY 1),
counted AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT image_id) AS records FROM tokens WHERE term IS NOT NULL GROUP BY 1, 2),
marked AS (SELECT c.*, CASE WHEN records < 3 THEN 'rare' WHEN records > n * 0.05 THEN 'common' END AS mark FROM counted c JOIN whole USING (field_name))
"""

# Bytes stand in for tokens here: the cases do not hang on the tokenizer.
_P7 = r"""
WITH sizes AS (SELECT lower(trim(source, ' ')) AS source, CAST(sum(CASE WHEN trim(text) <> '' THEN strlen(text) ELSE 0 END) AS DOUBLE) AS n FROM documents GROUP BY 1),
listed AS (SELECT mix_id, lower(trim(t.source, ' ')) AS source, target_share, max_repeats, coalesce(n, 0) AS n FROM mix_targets t LEFT JOIN sizes s ON s.source = lower(trim(t.source, ' '))),
goals AS (SELECT *, sum(n) OVER (PARTITION BY mix_id) * target_share / sum(target_share) OVER (PARTITION BY mix_id) AS goal FROM listed)
SELECT mix_id, source FROM goals WHERE n = 0 OR n * max_repeats < goal
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_shares": _P1 + "SELECT record_table, record_id, text, share AS repeated_share, share >= 0.3 AS repetitive FROM shares",
        "p1_found": _P1 + "SELECT DISTINCT record_table, record_id FROM shares WHERE share >= 0.3",
        "p2_found": _P2,
        "p4_sample": _P4,
        "p5_terms": _P5 + "SELECT field_name, term, occurrences, records, mark FROM marked",
        "p5_found": _P5 + "SELECT field_name, term, mark FROM marked WHERE mark IS NOT NULL",
        "p7_found": _P7,
    }
