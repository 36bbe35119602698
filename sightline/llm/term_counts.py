"""Occurrences and records of every distinct term, by last-seen counters.

Tokens are hash-partitioned by term and ordered by record; while the records of a term pass, a counter of records rises
whenever the record differs from the last one seen. No set of records is ever kept. A term is spread over ``salts``
partitions by its record, as many as the session shuffles into, so a term that holds a third of all tokens is counted by
all tasks, each record by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import written


def normal_term(value: str | None) -> str | None:
    """NFKC without invisible format characters, white space runs as one blank, trimmed, lower-cased; null if empty."""
    if value is None:
        return None
    if not value.isascii():
        value = unicodedata.normalize("NFKC", value)
        value = "".join(c for c in value if unicodedata.category(c) != "Cf")
        value = unicodedata.normalize("NFKC", value)
    return " ".join(value.split()).lower() or None


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalises each distinct value once and counts equal (field, term, record) rows within the batch."""
    for batch in batches:
        coded = pc.dictionary_encode(batch["value"])
        terms = pa.array([normal_term(v) for v in coded.dictionary.to_pylist()], pa.string())
        term = terms.take(coded.indices) if len(terms) else pa.nulls(len(batch), pa.string())
        rows = pa.table({"field": batch["field"], "term": term, "record": batch["record"]})
        rows = rows.filter(pc.is_valid(rows["term"])).append_column("n", pa.array([1] * (len(rows) - rows["term"].null_count), pa.int64()))
        counted = rows.group_by(["field", "term", "record"]).aggregate([("n", "sum")]).rename_columns(["field", "term", "record", "n"])
        yield from counted.combine_chunks().to_batches()


def count_terms(tokens: DataFrame, salts: int | None = None) -> DataFrame:
    """Counts of ``tokens`` (field, value, record): one row per field and term.

    Result: field, term, occurrences, records, field_records (distinct records with any term in the field). Null and
    empty terms are left out; a null record counts as an occurrence but as no record. The normalised tokens, counted within
    each batch, are stored once by a job that runs when this is called.
    """
    salts = salts or int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "field string, term string, record string, n bigint"
    counted = written(tokens.select("field", "value", F.col("record").cast("string").alias("record")).mapInArrow(_combined, schema), "tokens")
    salted = counted.withColumn("_salt", F.pmod(F.xxhash64("record"), F.lit(salts)).cast("int"))
    passing = Window.partitionBy("field", "term", "_salt").orderBy("record")
    seen = salted.withColumn("_last", F.lag("record").over(passing))
    is_new = (F.col("record").isNotNull() & ~F.col("record").eqNullSafe(F.col("_last"))).cast("bigint")
    by_salt = seen.withColumn("_new", is_new).groupBy("field", "term", "_salt").agg(F.sum("n").alias("n"), F.sum("_new").alias("r"))
    by_term = by_salt.groupBy("field", "term").agg(F.sum("n").alias("occurrences"), F.sum("r").alias("records"))
    whole = counted.filter("record is not null").select("field", "record").distinct().groupBy("field").agg(F.count("*").alias("field_records"))
    return by_term.join(whole, "field", "left").withColumn("field_records", F.coalesce("field_records", F.lit(0)))


def marked(counts: DataFrame, rare_below: int = 3, common_over: float = 0.05) -> DataFrame:
    """``counts`` with mark: 'rare' below ``rare_below`` records, 'common' over that share of records, else null."""
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.col("field_records") * common_over, "common")
    return counts.withColumn("mark", mark)
