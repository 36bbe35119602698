"""A sample that stays as data grows, by epoch-rate selection.

Each key's first-seen epoch is persisted with the rate frozen for that epoch, and a counter-based random generator keyed
by the identifier gives one draw per key. A key is chosen if its draw lies below its frozen rate. Later epochs neither
change a draw nor a frozen rate, so what was chosen stays chosen.

The ledger is a folder with one part per delivery. A delivery adds the keys that no earlier part holds and touches no
earlier part; delivering the same rows again writes the same part again. Its epoch is the delivery in which a key first
came, also for rows that say they belong to an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import scratch_path

LEDGER = "key string, first_epoch int, rate double"


def normal_key(c: Column) -> Column:
    """Trimmed of any white space, lower-cased; blank keys become null."""
    return F.nullif(F.lower(F.regexp_replace(c, r"^[\s\x{a0}\x{200b}\x{feff}]+|[\s\x{a0}\x{200b}\x{feff}]+$", "")), F.lit(""))


def draw(key: Column, seed: int = 0, counter: int = 0) -> Column:
    """Uniform number in [0, 1): 52 bits of MD5 in counter mode over (seed, counter, key).

    The generator has no state: the same identifier gives the same number in every run, partitioning and engine.
    """
    block = F.md5(F.concat(F.lit(f"{seed}:{counter}:"), key))
    return F.conv(F.substring(block, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def frozen_rate(epoch: Column, rates: dict[int, float]) -> Column:
    """The rate in force at ``epoch``: that of the latest entry of ``rates`` not after it; before the first entry, 0."""
    expr = F.lit(0.0)
    for start in sorted(rates):
        expr = F.when(epoch >= start, F.lit(float(rates[start]))).otherwise(expr)
    return expr


def first_seen(rows: DataFrame, key: str, epoch: str, rates: dict[int, float]) -> DataFrame:
    """Ledger of the keys of ``rows``: key, first_epoch, rate. Null keys are dropped; a null epoch counts as the last."""
    last = 2**31 - 1
    keyed = rows.select(normal_key(F.col(key)).alias("key"), F.coalesce(F.col(epoch).cast("int"), F.lit(last)).alias("_epoch")).filter("key is not null")
    ledger = keyed.groupBy("key").agg(F.min("_epoch").alias("first_epoch"))
    return ledger.withColumn("rate", frozen_rate(F.col("first_epoch"), rates))


def advance(ledger: DataFrame, rows: DataFrame, key: str, epoch: str, rates: dict[int, float]) -> DataFrame:
    """``ledger`` with the keys of ``rows`` it did not have; entries already there keep epoch and rate untouched."""
    fresh = first_seen(rows, key, epoch, rates).join(ledger.select("key"), "key", "left_anti")
    return ledger.select("key", "first_epoch", "rate").unionByName(fresh)


def read_ledger(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The ledger in the folder ``path`` (made if it is not there); with ``before`` only its parts of earlier deliveries."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    parts = spark.read.schema(LEDGER + ", delivery int").parquet(path)
    return (parts if before is None else parts.filter(F.col("delivery") < before)).select("key", "first_epoch", "rate")


def deliver(spark: SparkSession, path: str, rows: DataFrame, key: str, epoch: int, rates: dict[int, float]) -> DataFrame:
    """Writes the part of delivery ``epoch``: the keys of ``rows`` that no earlier part holds, with the rate of that epoch.

    Returns the ledger as it stands then. Deliveries come in ascending order.
    """
    known = read_ledger(spark, path, epoch)
    keys = rows.select(normal_key(F.col(key)).alias("key")).filter("key is not null").distinct()
    fresh = keys.join(known.select("key"), "key", "left_anti").select("key", F.lit(epoch).alias("first_epoch"), frozen_rate(F.lit(epoch), rates).alias("rate"))
    fresh.write.mode("overwrite").parquet(f"{path}/delivery={epoch}")
    return read_ledger(spark, path)


def replay(rows: DataFrame, key: str, epoch: str, rates: dict[int, float], path: str) -> DataFrame:
    """The ledger in ``path`` after all deliveries of ``rows`` (told apart by ``epoch``) have come one after the other.

    The rows are sorted into deliveries once and each delivery then reads its own part. Null epochs come last. The list of
    deliveries, not of records, is brought to the driver.
    """
    spark = rows.sparkSession
    own = rows.select(normal_key(F.col(key)).alias("key"), F.coalesce(F.col(epoch).cast("int"), F.lit(2**31 - 1)).alias("epoch"))
    at = scratch_path(spark, "deliveries")
    own.filter("key is not null").distinct().write.partitionBy("epoch").parquet(at)
    sorted_in = spark.read.schema("key string, epoch int").parquet(at)
    for e in sorted(r[0] for r in sorted_in.select("epoch").distinct().collect()):
        deliver(spark, path, sorted_in.filter(F.col("epoch") == e), "key", e, rates)
    return read_ledger(spark, path)


def chosen(ledger: DataFrame, seed: int = 0) -> DataFrame:
    """The ledger's keys whose draw lies below their frozen rate."""
    return ledger.withColumn("draw", draw(F.col("key"), seed)).filter(F.col("draw") < F.col("rate"))
