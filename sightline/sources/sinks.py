"""Record sinks and incremental snapshots. Writes go through Spark's commit protocol: all of a job or nothing."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators.relational import changes

FAILURE = "image_id string, stage string, error_class string, message string, at timestamp"


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, nulls kept; ``mode`` as in Spark: errorifexists, overwrite, append."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_index(df: DataFrame, path: str, order: list[str]) -> None:
    """A CSV index in one file for reviewers. Only for tables a person can read."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def append_failures(df: DataFrame, path: str) -> None:
    """Typed failure rows (see ``FAILURE``) appended to a Parquet table; missing columns become null."""
    have = set(df.columns)
    columns = [x.split() for x in FAILURE.split(", ")]
    df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in columns]).write.mode("append").parquet(path)


def provenance(spark: SparkSession, config: dict, **named: str) -> DataFrame:
    """One row: hash of the configuration, names given by the caller, engine version and time."""
    text = json.dumps(config, sort_keys=True, default=str)
    row = spark.range(1).select(F.sha2(F.lit(text), 256).alias("config_sha256"), F.lit(spark.version).alias("engine"), F.current_timestamp().alias("recorded_at"))
    return row.withColumns({k: F.lit(v) for k, v in named.items()}) if named else row


SEAL = "version int, parent string, digest string"


def _digest(spark: SparkSession, folder: str, parent: str | None) -> str:
    """Digest over all rows and tombstones of one version, in any order, and its parent's digest."""
    parts = []
    for name in ("rows", "tombstones"):
        df = spark.read.parquet(f"{folder}/{name}")
        one = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
        r = df.agg(F.count("*").alias("n"), F.sum(one).alias("s")).first()
        parts.append(f"{name}:{r['n']}:{r['s']}")
    return hashlib.sha256("|".join([*parts, parent or ""]).encode()).hexdigest()


def commit_snapshot(spark: SparkSession, current: DataFrame, previous: DataFrame | None, keys: list[str], signature: str, path: str, version: int) -> dict[str, int]:
    """Writes what changed since ``previous``: rows new or changed, tombstones of removed keys, and a seal. Returns the counts.

    The seal comes last, with a digest of what was written and that of the version before it, so that an unfinished or
    altered version is told when it is restored.
    """
    from sightline.session import written

    old = current.limit(0) if previous is None else previous
    delta = written(changes(old, current, keys, signature), "delta")
    folder = f"{path}/v{version:06d}"
    rows = current.join(delta.filter("change <> 'removed'"), keys).withColumn("version", F.lit(version))
    rows.write.mode("overwrite").parquet(f"{folder}/rows")
    delta.filter("change = 'removed'").select(*keys).withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{folder}/tombstones")
    parent = spark.read.schema(SEAL).parquet(f"{path}/v{version - 1:06d}/seal").first()["digest"] if version > 1 else None
    spark.createDataFrame([(version, parent, _digest(spark, folder, parent))], SEAL).coalesce(1).write.mode("overwrite").parquet(f"{folder}/seal")
    return {r["change"]: r["count"] for r in delta.groupBy("change").count().collect()}


def checked_chain(spark: SparkSession, path: str, version: int) -> None:
    """Ends with an error unless every version up to ``version`` has its seal, fits the one before and reads as it was written."""
    parent = None
    for v in range(1, version + 1):
        seal = spark.read.schema(SEAL).parquet(f"{path}/v{v:06d}/seal").first()
        if seal is None or seal["parent"] != parent or seal["digest"] != _digest(spark, f"{path}/v{v:06d}", parent):
            raise ValueError(f"snapshot {v} was altered or does not follow the one before it")
        parent = seal["digest"]


def restore_snapshot(spark: SparkSession, path: str, version: int, keys: list[str]) -> DataFrame:
    """The table as of ``version``: of each key the last row written up to it, without those removed later.

    The chain of versions is checked first (see ``checked_chain``).
    """
    from sightline.operators.relational import first_per_key

    checked_chain(spark, path, version)
    parts = range(1, version + 1)
    rows = spark.read.parquet(*[f"{path}/v{v:06d}/rows" for v in parts])
    gone = spark.read.parquet(*[f"{path}/v{v:06d}/tombstones" for v in parts])
    state = rows.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
    last = first_per_key(state, keys, [F.desc("version")])
    return last.filter("not _gone").drop("_gone", "version", "change")
