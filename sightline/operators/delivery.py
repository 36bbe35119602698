"""Deliveries: one state fanned out into the tables that are handed over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.geometry import box, clip, is_valid

REASON_CHARS = 1200


def fan_out(objects: DataFrame, searches: DataFrame, candidates: DataFrame, images: DataFrame, rejected: tuple[str, ...] = ("rejected", "unresolved_identity")) -> dict[str, DataFrame]:
    """The six tables of a delivery: objects, verified, unresolved, search_audit, rejected, counts_by_image.

    ``objects`` has image_id, status, phrase and reason; what is not 'verified' is unresolved, with its reason or that no
    phrase was reached. ``searches`` has open (hints not done), ``candidates`` status and reason. ``images`` gives the
    images that are counted, also those without an object; its repeated rows count once. Other columns are kept.
    """
    cut = lambda c: F.substring(c, 1, REASON_CHARS)
    good = F.coalesce(F.col("status") == "verified", F.lit(False))
    counted = objects.groupBy("image_id").agg(F.count_if(good).alias("final_count"), F.count("*").alias("object_count"), F.count_if(~good).alias("unresolved_count"))
    counts = images.select("image_id").distinct().join(counted, "image_id", "left").fillna(0, ["final_count", "object_count", "unresolved_count"])
    why = F.when(F.col("phrase").isNull() & F.col("reason").isNull(), "no_phrase_before_search_drain_completed").otherwise(F.coalesce("reason", F.lit("")))
    return {
        "objects": objects,
        "verified": objects.filter(good).drop("reason"),
        "unresolved": objects.filter(~good).withColumn("reason", cut(why)),
        "search_audit": searches.withColumn("stop_reason", F.when(F.col("open") > 0, "budget_exhausted").otherwise("no_pending_evidence")),
        "rejected": candidates.filter(F.col("status").isin(*rejected)).withColumn("reason", cut(F.coalesce("reason", F.lit("")))),
        "counts_by_image": counts,
    }


def write_delivery(tables: dict[str, DataFrame], path: str) -> None:
    """Every table as record lines under ``path``; each is committed as a whole or not at all."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def read_delivery(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(df.schema).json(f"{path}/{name}") for name, df in tables.items()}


def inserted(found: DataFrame, held: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """Detections of ``found`` to be added to ``held``: inside their image, told apart by ``identity`` and the box.

    Boxes outside the image (width, height) are left out; of equal ones the first in ``order`` stays, and none that is held.
    """
    same = [*identity, "x1", "y1", "x2", "y2"]
    rest = [c for c in found.columns if c not in same]
    ok = found.filter(is_valid(box(), F.col("width"), F.col("height")))
    first = ok.groupBy(*same).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    new = first.select(*same, *[F.col("_r")[c].alias(c) for c in rest])
    return new.join(held.select(*same).distinct(), same, "left_anti")


def clipped_lists(boxes: str, width: str, height: str):
    """The boxes of an array column clipped to the image, without those that are then invalid; order is kept."""
    from sightline.functions.geometry import field_box

    w, h = F.col(width), F.col(height)

    def inside(b):
        c = clip(field_box(b), w, h)
        return F.struct(*[v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), c)], b["score"].alias("score"))

    return F.filter(F.transform(F.col(boxes), inside), lambda b: is_valid(field_box(b), w, h))
