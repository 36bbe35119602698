"""Joins of boxes within a key.

Pairs that must overlap are found through a grid: each box is put into every cell it covers, boxes meet within cells,
and a pair is emitted only in the cell that holds the corner of its intersection, so no pair comes twice and none needs
to be made distinct. A key that holds very many boxes is thereby cut into cells and never compared as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import box, center_distance, center_offset, containment, iou, size_ratio
from sightline.session import written

CELL = 256.0


def fitting_cell(df: DataFrame, most_cells: int = 64) -> float:
    """A cell as wide as the boxes of ``df`` are on the average, or so wide that none covers more than ``most_cells`` a side."""
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    told = df.filter(side > 0).agg(F.avg(side).alias("mean"), F.max(side).alias("most")).first()
    return max(told["mean"], told["most"] / most_cells) if told["mean"] else CELL


def gridded(df: DataFrame, cell: float = CELL) -> DataFrame:
    """One row for each cell that a row's box covers, in columns _cx, _cy."""
    across = F.sequence(F.floor(F.col("x1") / cell), F.floor(F.greatest("x1", "x2") / cell))
    down = F.sequence(F.floor(F.col("y1") / cell), F.floor(F.greatest("y1", "y2") / cell))
    inside = df.filter("x1 is not null and y1 is not null and x2 is not null and y2 is not null")
    return inside.withColumn("_cx", F.explode(across)).withColumn("_cy", F.explode(down))


def overlapping_pairs(left: DataFrame, right: DataFrame, keys: list[str], condition: Column, cell: float = CELL, kind: str = "inner") -> DataFrame:
    """Pairs (aliases a and b) of equal keys whose boxes overlap and meet ``condition``; null keys pair with none.

    ``condition`` must imply an overlap, as any bound above 0 on IoU or containment does.
    """
    a, b = gridded(left, cell).alias("a"), gridded(right, cell).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_cx", "_cy"]]
    corner = (F.floor(F.greatest("a.x1", "b.x1") / cell) == F.col("a._cx")) & (F.floor(F.greatest("a.y1", "b.y1") / cell) == F.col("a._cy"))
    return a.join(b, on + [corner, condition], kind)


def without_overlap(left: DataFrame, right: DataFrame, keys: list[str], row: list[str], threshold: float, cell: float = CELL) -> DataFrame:
    """Rows of ``left`` (told apart by ``row``) with no box of ``right`` at ``threshold`` IoU: NOT EXISTS."""
    a, b = box("a."), box("b.")
    hit = overlapping_pairs(left, right, keys, iou(a, b) >= threshold, cell).select(*[F.col(f"a.{c}") for c in row]).distinct()
    return left.join(hit, row, "left_anti")


def duplicate_suspects(df: DataFrame, image: str, row: str, exact: float = 0.98, suspect: float = 0.75, min_size_ratio: float = 0.7, max_offset: float = 0.2) -> DataFrame:
    """Pairs that are or may be one target: image, first, second, tier.

    Tiers: 'text' for equal phrases (trimmed, lower-cased, not empty), then for equal scopes 'identical' (same category
    and IoU of ``exact``), then 'undecided' (overlap, extent and centre alike; another judge decides). ``df`` has the
    columns scope, category, phrase and the box.
    """
    tidy = df.withColumn("_t", F.lower(F.trim(F.coalesce("phrase", F.lit("")))))
    # Equal phrases: linked to the first row that has it, a class instead of all pairs.
    worded = tidy.filter("_t <> ''")
    leads = worded.groupBy(image, "_t").agg(F.min(row).alias("first"))
    same_text = worded.join(leads, [image, "_t"]).filter(F.col("first") != F.col(row))
    texts = same_text.select(image, "first", F.col(row).alias("second"), F.lit("text").alias("tier"))
    a, b = box("a."), box("b.")
    scoped = tidy.filter("coalesce(scope, '') <> ''")
    like = (size_ratio(a, b) <= 1 / min_size_ratio) & (center_offset(a, b) <= max_offset)
    automatic = (F.coalesce("a.category", F.lit("")) != "") & (F.col("a.category") == F.col("b.category")) & (iou(a, b) >= exact)
    other_text = (F.col("a._t") != F.col("b._t")) | (F.col("a._t") == "")
    near = overlapping_pairs(scoped, scoped, [image, "scope"], (F.col(f"a.{row}") < F.col(f"b.{row}")) & (iou(a, b) >= suspect) & other_text & (automatic | like))
    boxes = near.select(F.col(f"a.{image}").alias(image), F.col(f"a.{row}").alias("first"), F.col(f"b.{row}").alias("second"), F.when(automatic, "identical").otherwise("undecided").alias("tier"))
    return texts.unionByName(boxes)


def nearest(df: DataFrame, image: str, row: str, k: int) -> DataFrame:
    """For each row its ``k`` nearest others of the image by centre, ties by row: image, row, other, distance.

    ``df`` has the box and width and height of the image; distances are squares in shares of the image. Centres are put into
    cells as wide as hold about ``k`` of them. A row meets the rows of its own and the eight cells around; it is done once its
    ``k``-th distance is less than a cell's width, and else looks again among cells twice as wide. So an image of any size
    is cut into cells, and few rows look far. Rows without a centre are near to none.
    """
    slim = df.select(image, row, "x1", "y1", "x2", "y2", "width", "height", ((F.col("x1") + F.col("x2")) / 2 / F.col("width")).alias("_u"), ((F.col("y1") + F.col("y2")) / 2 / F.col("height")).alias("_v"))
    slim = slim.filter("_u is not null and _v is not null and not isnan(_u) and not isnan(_v)")
    of_image = slim.groupBy(image).agg(F.count("*").alias("_n"), F.min("_u").alias("_u0"), F.min("_v").alias("_v0"), F.greatest(F.max("_u") - F.min("_u"), F.max("_v") - F.min("_v")).alias("_wide"))
    cell = F.when(F.col("_wide") > 0, F.col("_wide") * F.least(F.lit(1.0), F.sqrt(k / F.col("_n")))).otherwise(1.0)
    points = written(slim.join(of_image, image).withColumn("_cell", cell), "centres")
    found = None
    left, factor = points, 1.0
    while True:
        at = lambda c, f=factor: F.floor((F.col(f"_{c}") - F.col(f"_{c}0")) / (F.col("_cell") * f))
        around = lambda c: F.explode(F.array(c - 1, c, c + 1))
        a = left.withColumn("_cx", around(at("u"))).withColumn("_cy", around(at("v"))).alias("a")
        b = points.withColumn("_cx", at("u")).withColumn("_cy", at("v")).alias("b")
        met = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (image, "_cx", "_cy")] + [F.col(f"a.{row}") != F.col(f"b.{row}")])
        d = center_distance(box("a."), box("b."), F.col("a.width"), F.col("a.height"))
        flat = met.select(F.col(f"a.{image}").alias(image), F.col(f"a.{row}").alias(row), F.col(f"b.{row}").alias("other"), d.alias("distance"), F.col("a._n").alias("_n"), (F.col("a._cell") * factor).alias("_c"), F.col("a._wide").alias("_wide"))
        near = flat.withColumn("_k", F.row_number().over(Window.partitionBy(image, row).orderBy("distance", "other"))).filter(F.col("_k") <= k)
        whole = Window.partitionBy(image, row)
        sure = (F.count("*").over(whole) >= F.least(F.lit(k), F.col("_n") - 1)) & ((F.max("distance").over(whole) < F.pow(F.col("_c") * (1 - 1e-9), 2)) | (F.count("*").over(whole) == F.col("_n") - 1) | (F.col("_c") >= F.col("_wide")))
        settled = written(near.withColumn("_sure", sure).filter("_sure").select(image, row, "other", "distance"), "near")
        found = settled if found is None else found.unionByName(settled)
        left = written(left.filter("_n > 1").join(settled.select(image, row).distinct(), [image, row], "left_anti"), "far")
        if not left.limit(1).count():
            return found
        factor *= 2


def near_rows(df: DataFrame, image: str, row: str, k: int = 8, min_containment: float = 0.6) -> DataFrame:
    """Rows that a phrase for ``row`` might be taken to mean for where they are: image, row, other, place.

    They are among its ``k`` nearest, or one of the two boxes lies in the other by ``min_containment``; by distance, then row.
    """
    a, b = box("a."), box("b.")
    over = F.greatest(containment(a, b), containment(b, a)) >= min_containment
    pairs = overlapping_pairs(df, df, [image], (F.col(f"a.{row}") != F.col(f"b.{row}")) & over)
    d = center_distance(a, b, F.col("a.width"), F.col("a.height"))
    covered = pairs.select(F.col(f"a.{image}").alias(image), F.col(f"a.{row}").alias(row), F.col(f"b.{row}").alias("other"), d.alias("distance"))
    either = covered.unionByName(nearest(df, image, row, k)).groupBy(image, row, "other").agg(F.min("distance").alias("distance"))
    return either.withColumn("place", F.row_number().over(Window.partitionBy(image, row).orderBy("distance", "other"))).drop("distance")


def peer_classes(df: DataFrame, image: str, row: str, classes: dict[str, Column]) -> DataFrame:
    """Rows that a phrase for ``row`` might be taken to mean for what they are called: image, row, kind, value, others.

    ``classes`` gives for each kind the values (an array) that a row has. Rows of one image that share a value form a class;
    each row is told with its classes and how many others are in them, instead of with every other row. Nulls and empty
    values make no class.
    """

    def told(kind: str, values: Column) -> Column:
        return F.transform(F.array_distinct(F.coalesce(values, F.array().cast("array<string>"))), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value")))

    kinds = F.concat(*[told(k, v) for k, v in classes.items()])
    flat = df.select(image, row, F.inline(kinds)).filter("value is not null and value <> ''")
    sizes = flat.groupBy(image, "kind", "value").agg((F.count("*") - 1).alias("others"))
    return flat.join(sizes, [image, "kind", "value"]).select(image, row, "kind", "value", "others")
