"""Session defaults and the shared folder of the cluster."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "sightline", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    base = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(app).config(map=base | {k.replace("__", "."): v for k, v in conf.items()})
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read, as the cluster names it in ``spark.checkpoint.dir``.

    Only on one machine (a local master), where that setting is absent, a temporary folder is made and set; a cluster
    without the setting is an error, as its executors could not read each other's disks.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = "file://" + tempfile.mkdtemp(prefix="sightline-")
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and tasks share one machine and process: 'local', 'local[n]', but not 'local-cluster[...]'."""
    return master == "local" or master.startswith("local[")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended already; the folder is then the cluster's to clear
        pass


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name inside the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Removes what ``written`` stored, once nothing reads it any more."""
    _remove(stored.sparkSession, stored.stored_at)

