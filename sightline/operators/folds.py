"""Greedy selections in a fixed order: a row is kept unless it is too like one kept before.

What is compared are kept rows only, so likeness is never passed on from one dropped row to the next. Two rows are alike if
their boxes overlap enough or if they agree in one of the columns named for that. Groups up to ``FOLD_ROWS`` rows are
folded in one expression over their sorted list. In larger groups the same answer is found in rounds: a row is kept once no
undecided or kept row before it is like it, and dropped once a kept row before it is. Overlaps are found through a grid and
equal values by one minimum a value, so no task holds a whole group and no group is joined with itself on its key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import box, field_box, iou
from sightline.operators.spatial import fitting_cell, overlapping_pairs
from sightline.session import discard, written

FOLD_ROWS = 2_000
_BOX = ["x1", "y1", "x2", "y2"]


def _over(overlap: Column, threshold: float, strict: bool) -> Column:
    return overlap > threshold if strict else overlap >= threshold


def _fold(df: DataFrame, keys: list[str], rank: str, threshold: float, equal: list[str], strict: bool) -> DataFrame:
    """Adds ``winner``: the rank of the kept row that a row is too like, null for kept rows."""
    columns, kind = [c for c in df.columns if c not in keys], dict(df.dtypes)
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(rank).alias("_r"), *[F.col(c) for c in columns]))).alias("_rows"))
    seen = "struct<_r:" + kind[rank] + "," + ",".join(f"`{c}`:{kind[c]}" for c in [*_BOX, *equal]) + ">"
    start = F.struct(F.array().cast(f"array<{seen}>").alias("kept"), F.array().cast(f"array<{kind[rank]}>").alias("winners"))

    def like(k: Column, x: Column) -> Column:
        test = _over(iou(field_box(k), field_box(x)), threshold, strict)
        for c in equal:
            test |= F.coalesce(k[c] == x[c], F.lit(False))
        return test

    def step(done: Column, x: Column) -> Column:
        first = F.get(F.filter(done["kept"], lambda k: like(k, x)), F.lit(0))["_r"]
        own = F.struct(x["_r"].alias("_r"), *[x[c].alias(c) for c in [*_BOX, *equal]])
        # The one-element list holds the winner, so that it is searched once.
        grown = F.transform(F.array(first), lambda w: F.struct(F.when(w.isNull(), F.concat(done["kept"], F.array(own))).otherwise(done["kept"]).alias("kept"), F.concat(done["winners"], F.array(w)).alias("winners")))
        return F.get(grown, F.lit(0))

    alone = F.array(F.lit(None).cast(kind[rank]))
    winners = F.when(F.size("_rows") == 1, alone).otherwise(F.aggregate("_rows", start, step, lambda a: a["winners"]))
    folded = rows.select(*keys, F.explode(F.arrays_zip(F.col("_rows").alias("row"), winners.alias("winner"))).alias("_x"))
    return folded.select(*keys, *[F.col("_x.row")[c].alias(c) for c in columns], F.col("_x.winner").alias("winner"))


def _rounds(df: DataFrame, keys: list[str], rank: str, threshold: float, equal: list[str], strict: bool) -> DataFrame:
    group = F.struct(*keys).alias("_g")  # a struct, so that null keys are a group as well
    slim = df.select(group, F.col(rank).alias("_r"), *_BOX, *equal)
    near = (F.col("a._r") < F.col("b._r")) & _over(iou(box("a."), box("b.")), threshold, strict)
    pairs = overlapping_pairs(slim, slim, ["_g"], near, fitting_cell(slim))
    edges = written(pairs.select(F.col("a._g").alias("_g"), F.col("a._r").alias("before"), F.col("b._r").alias("after")), "likeness")
    state = written(slim.select("_g", "_r", *equal, F.lit(None).cast(dict(slim.dtypes)["_r"]).alias("winner"), F.lit(False).alias("kept")), "fold-state")
    undecided = ~F.col("kept") & F.col("winner").isNull()
    first_kept, first_open = F.min(F.when(F.col("kept"), F.col("_r"))), F.min(F.when(undecided, F.col("_r")))
    while state.filter(undecided).limit(1).count():
        before = edges.join(state.select("_g", F.col("_r").alias("before"), F.col("_r"), "kept", "winner"), ["_g", "before"])
        told = before.groupBy("_g", F.col("after").alias("_r")).agg(first_kept.alias("_k0"), first_open.alias("_o0"))
        d = state.join(told, ["_g", "_r"], "left")
        kept, opened = [F.col("_k0")], [F.col("_o0")]
        for n, c in enumerate(equal, 1):
            d = d.join(state.groupBy("_g", c).agg(first_kept.alias(f"_k{n}"), first_open.alias(f"_o{n}")), ["_g", c], "left")
            kept.append(F.when(F.col(f"_k{n}") < F.col("_r"), F.col(f"_k{n}")))
            opened.append(F.when(F.col(f"_o{n}") < F.col("_r"), F.col(f"_o{n}")))
        least = lambda cs: F.least(*cs) if len(cs) > 1 else cs[0]
        w, o = least(kept), least(opened)
        # The first kept row like it is its winner once nothing undecided stands before that.
        settled = undecided & w.isNotNull() & (o.isNull() | (o > w))
        new = written(d.select("_g", "_r", *equal, F.when(settled, w).otherwise(F.col("winner")).alias("winner"), (F.col("kept") | (undecided & w.isNull() & o.isNull())).alias("kept")), "fold-state")
        discard(state)
        state = new
    discard(edges)
    out = df.withColumn("_g", group).alias("d").join(state.alias("s"), [F.col("d._g") == F.col("s._g"), F.col(f"d.{rank}") == F.col("s._r")])
    return out.select(*[F.col(f"d.{c}") for c in df.columns], F.col("s.winner"))


def greedy(df: DataFrame, keys: list[str], rank: str, threshold: float, equal: tuple[str, ...] = (), strict: bool = False, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """``df`` with ``winner``: null for kept rows, else the ``rank`` of the first kept row that the row is too like.

    Rows of a group are alike from ``threshold`` IoU (over 0; above it if ``strict``) of their boxes x1..y2, or if a column
    of ``equal`` has one value in both; nulls are like nothing. ``rank`` is unique within the keys and gives the order; null
    keys are groups as well. The input is stored first, by a job that runs when this is called, so it is computed once.
    A chain of rows, each like the next, settles two rows a round in groups over ``fold_rows``.
    """
    stored = written(df, "fold-input")
    large = stored.groupBy(*keys).count().filter(F.col("count") > fold_rows).drop("count")
    if not large.limit(1).count():
        return _fold(stored, keys, rank, threshold, list(equal), strict)
    large = written(large, "large-groups")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    big = stored.alias("d").join(large.alias("l"), same, "left_semi")
    rest = stored.alias("d").join(large.alias("l"), same, "left_anti")
    columns = [*df.columns, "winner"]
    return _fold(rest, keys, rank, threshold, list(equal), strict).select(*columns).unionByName(_rounds(big, keys, rank, threshold, list(equal), strict).select(*columns))


def suppress(df: DataFrame, keys: list[str], rank: str, threshold: float, strict: bool = False, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Non-maximum suppression: rows (with columns x1..y2) not overlapping a kept one by ``threshold`` IoU."""
    return greedy(df, keys, rank, threshold, (), strict, fold_rows).filter("winner is null").drop("winner")


def context_views(df: DataFrame, keys: list[str], rank: str, second: Column) -> DataFrame:
    """The first views of every key in order of ``rank``: 3, or 2 where ``second`` (a second target is present).

    The full image (boxes of 0, 0, width, height) and views that overlap a kept one by more than 0.97 are dropped first.
    """
    full = (F.col("x1") == 0) & (F.col("y1") == 0) & (F.col("x2") == F.col("width")) & (F.col("y2") == F.col("height"))
    kept = suppress(df.filter(~full), keys, rank, 0.97, strict=True)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(rank))
    return kept.withColumn("place", place).filter(F.col("place") <= F.when(second, 2).otherwise(3))
