"""What several operators of the subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.epoch_sample import normal_key


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as the session has cores.

    Only input of fewer splits is moved (a small table in one file); larger input is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def caption_texts(manifest: DataFrame, drafts: DataFrame) -> DataFrame:
    """The captions and expressions as one table: record_table, record_id, origin, text.

    record_id is the trimmed, lower-cased image_id or the expression_id; origin is the trimmed, lower-cased dataset or
    writer model ('' where it is null).
    """
    tidy = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    captions = manifest.select(F.lit("manifest").alias("record_table"), normal_key(F.col("image_id")).alias("record_id"), tidy(F.col("dataset")).alias("origin"), F.col("caption").alias("text"))
    phrases = drafts.select(F.lit("expression_drafts").alias("record_table"), F.col("expression_id").alias("record_id"), tidy(F.col("writer_model")).alias("origin"), F.col("expression").alias("text"))
    return captions.unionByName(phrases)


def sample_rows(df: DataFrame, columns: list[str], n: int, seed: int = 0) -> list:
    """At most ``n`` distinct rows of ``df``, the same in every run: those with the least hash. Each task sends ``n``."""
    order = F.xxhash64(F.lit(seed), *columns)
    return df.select(*columns).distinct().orderBy(order, *columns).limit(n).collect()


