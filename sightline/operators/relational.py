"""Keyed selections, counts, set comparisons and resumption.

Every ordered operator takes a total order from the caller; where the order may tie, the last key should be a unique
one. Nulls among the keys form groups of their own, as in SQL's GROUP BY.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import discard, written


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """Rows numbered 1..n within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered_spread(df: DataFrame, keys: list[str], order: list[Column], name: str = "place", kind: str = "int") -> DataFrame:
    """As ``numbered`` for keys of any size: no task holds a whole key.

    The rows are range-partitioned by key and order and stored; each part is numbered by itself and gets the number of
    its key's rows in the parts before it. ``order`` must be total.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys], *order).withColumn("_part", F.spark_partition_id())
    stored = written(ranged, "ranged")
    by = [*keys, "_part"]
    counts = stored.groupBy(*by).agg(F.count("*").alias("_c"))  # per key at most one row per part
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    own = stored.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in by]
    # Without keys there is one offset a part; else the planner decides.
    joined = own.alias("r").join((offsets if keys else F.broadcast(offsets)).alias("o"), same)
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._n") + F.col("o._before")).cast(kind).alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``. Only the best row of each task crosses the shuffle (window group limit)."""
    return numbered(df, keys, order, "_n").filter("_n = 1").drop("_n")


def latest_per_key(df: DataFrame, keys: list[str], version: str, arrival: list[Column]) -> DataFrame:
    """The row with the highest ``version``; among equal ones the first to arrive. Null versions come last."""
    return first_per_key(df, keys, [F.col(version).desc_nulls_last(), *arrival])


def capped(df: DataFrame, keys: list[str], order: list[Column], limit: int | None, stage: str = "final_cap", reason: str = "per_source_cap") -> DataFrame:
    """All rows with ``place``, ``kept`` and, for those past ``limit``, stage and reason. No limit keeps all.

    ``order`` must be total; keys may be of any size.
    """
    d = numbered_spread(df, keys, order)
    kept = F.lit(True) if limit is None else F.col("place") <= limit
    return d.withColumn("kept", kept).withColumn("reject_stage", F.when(~F.col("kept"), stage)).withColumn("reject_reason", F.when(~F.col("kept"), reason))


def paged(df: DataFrame, keys: list[str], order: list[Column], size: int) -> DataFrame:
    """Rows with page (from 0) and place in it (from 1)."""
    n = F.col("_n") - 1
    d = numbered(df, keys, order, "_n").withColumn("page", F.floor(n / size).cast("int")).withColumn("page_place", (n % size + 1).cast("int"))
    return d.drop("_n")


def islands(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Consecutive rows of equal ``value`` folded: keys, phase (from 1), value, rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    d = df.withColumn("_o", F.row_number().over(w)).withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.col("_o") == 1)).cast("int"))
    d = d.withColumn("phase", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*keys, "phase").agg(F.first(value).alias(value), F.count("*").alias("rows"))


def counts_with_zeros(base: DataFrame, rows: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per key of ``base``; 0 for keys without any. ``rows`` is counted before the join."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias(name))
    return base.select(*keys).distinct().join(counted, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def histogram(counts: DataFrame, column: str) -> DataFrame:
    return counts.groupBy(column).agg(F.count("*").alias("groups"))


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs whose key is not among the completed ones."""
    return inputs.join(done.select(*keys).distinct(), keys, "left_anti")


def unchanged_and_stale(inputs: DataFrame, stored: DataFrame, keys: list[str], signature: str = "signature") -> tuple[DataFrame, DataFrame]:
    """Stored results whose signature still holds, and the inputs that must be computed (again)."""
    current = inputs.select(*keys, signature)
    reused = stored.join(current, [*keys, signature], "left_semi")
    return reused, inputs.join(reused.select(*keys, signature), [*keys, signature], "left_anti")


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that stand more often on one side: all columns, surplus_left, surplus_right. Empty if the bags are equal."""
    columns = left.columns
    both = left.withColumn("_s", F.lit(1)).unionByName(right.select(*columns).withColumn("_s", F.lit(-1)))
    net = both.groupBy(*columns).agg(F.sum("_s").alias("_d")).filter("_d <> 0")
    return net.select(*columns, F.greatest("_d", F.lit(0)).alias("surplus_left"), F.greatest(-F.col("_d"), F.lit(0)).alias("surplus_right"))


def changes(old: DataFrame, new: DataFrame, keys: list[str], signature: str) -> DataFrame:
    """Keys that were added, removed or changed between two versions: keys, change."""
    o, n = old.select(*keys, F.col(signature).alias("_o")), new.select(*keys, F.col(signature).alias("_n"))
    j = o.withColumn("_in_o", F.lit(True)).join(n.withColumn("_in_n", F.lit(True)), keys, "full")
    change = F.when(F.col("_in_o").isNull(), "added").when(F.col("_in_n").isNull(), "removed").when(~F.col("_o").eqNullSafe(F.col("_n")), "changed")
    return j.withColumn("change", change).filter("change is not null").select(*keys, "change")


def partition_faults(whole: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Keys that do not stand exactly once among the parts of ``whole``: keys, in_whole, in_parts."""
    all_parts = parts[0].select(*keys)
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p.select(*keys))
    tagged = whole.select(*keys, F.lit(1).alias("w"), F.lit(0).alias("p")).unionByName(all_parts.select(*keys, F.lit(0).alias("w"), F.lit(1).alias("p")))
    return tagged.groupBy(*keys).agg(F.sum("w").alias("in_whole"), F.sum("p").alias("in_parts")).filter("in_whole <> 1 or in_parts <> 1")


def signature_of(*columns: str) -> Column:
    """Hash of the named columns, nulls told from empty."""
    from sightline.functions.text import content_key

    return content_key(*[F.col(c) for c in columns])


def answer_faults(expected: DataFrame, returned: DataFrame, keys: list[str], id: str) -> DataFrame:
    """Whether the ids returned for a key are the expected ones exactly once: keys, missing, foreign, repeated, complete."""
    asked = expected.select(*keys, id).distinct().withColumn("_asked", F.lit(True))
    given = returned.groupBy(*keys, id).agg(F.count("*").alias("_n"))
    j = asked.join(given, [*keys, id], "full").groupBy(*keys)
    faults = j.agg(F.count_if(F.col("_n").isNull()).alias("missing"), F.count_if(F.col("_asked").isNull()).alias("foreign"), F.sum(F.greatest(F.col("_n") - 1, F.lit(0))).alias("repeated"))
    return faults.withColumn("complete", (F.col("missing") == 0) & (F.col("foreign") == 0) & (F.col("repeated") == 0))


def conflict_ids(comparisons: DataFrame, declared: DataFrame, keys: list[str], id: str) -> DataFrame:
    """keys and id of every compared object that also matches, and of every competitor that was declared, once each."""
    return comparisons.filter("also_matches").select(*keys, id).union(declared.select(*keys, id)).distinct()


def coverage(records: DataFrame, keys: list[str]) -> DataFrame:
    """What answers cover: total, valid, invalid, empty, proposals, rechecked, recovered, empty_share, distribution, warning.

    ``records`` has invalid (null: no), found (null: none) and rechecked. Invalid answers count as nothing else. The share
    is null without valid answers; the distribution is text, 'found:answers' in rising order; the warning is set if all
    valid answers are empty, or half of ten or more.
    """
    rows = records.select(*keys, F.coalesce("invalid", F.lit(False)).alias("_bad"), F.coalesce("found", F.lit(0)).cast("bigint").alias("_f"), F.coalesce("rechecked", F.lit(False)).alias("_again"))
    counted = rows.groupBy(*keys, "_bad", "_f").agg(F.count("*").alias("_n"), F.count_if("_again").alias("_a"))  # then one row for each number found
    good, some = ~F.col("_bad"), ~F.col("_bad") & (F.col("_f") > 0)
    total = lambda test, of="_n": F.coalesce(F.sum(F.when(test, F.col(of))), F.lit(0))
    listed = F.sort_array(F.collect_list(F.when(good, F.struct("_f", "_n"))))
    g = counted.groupBy(*keys).agg(
        F.sum("_n").alias("total"), total(good).alias("valid"), total(F.col("_bad")).alias("invalid"), total(good & (F.col("_f") == 0)).alias("empty"),
        F.coalesce(F.sum(F.when(good, F.col("_f") * F.col("_n"))), F.lit(0)).alias("proposals"), total(good, "_a").alias("rechecked"), total(some, "_a").alias("recovered"),
        F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["_f"].cast("string"), x["_n"].cast("string"))), ",").alias("distribution"),
    )
    share = F.when(F.col("valid") > 0, F.col("empty") / F.col("valid"))
    alarm = (F.col("valid") > 0) & ((F.col("empty") == F.col("valid")) | ((F.col("valid") >= 10) & (F.col("empty") * 2 >= F.col("valid"))))
    return g.withColumn("empty_share", share).withColumn("warning", alarm)


def column_faults(whole: DataFrame, parts: list[DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of the parts that differ from their row of ``whole``: keys, differing (the columns' names). Nulls are equal."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    j = whole.alias("w").join(rows.alias("p"), [F.col(f"w.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys])
    names = F.concat_ws(",", *[F.when(~F.col(f"w.{c}").eqNullSafe(F.col(f"p.{c}")), c) for c in columns])
    return j.select(*[F.col(f"w.{k}").alias(k) for k in keys], names.alias("differing")).filter("differing <> ''")


def group_versions(rows: DataFrame, keys: list[str], id: str, version: str) -> DataFrame:
    """``rows`` with ``_version``: a hash that changes with the row's own version or with any id or version of its group.

    The group's part is a sum over hashes, added up in the tasks, so no list of a group is made.
    """
    one = F.xxhash64(id, version).cast("decimal(38,0)")
    group = rows.groupBy(*keys).agg(F.sum(one).alias("_sum"), F.count("*").alias("_size"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    return rows.alias("r").join(group.alias("g"), same).select("r.*", signature_of("r." + id, "r." + version, "g._sum", "g._size").alias("_version"))


def stale(current: DataFrame, before: DataFrame, keys: list[str], id: str, version: str) -> DataFrame:
    """Rows of ``current`` that must be computed anew: new ones, and those whose own version or group has changed."""
    old = group_versions(before, keys, id, version).select(*keys, id, "_version")
    new = group_versions(current, keys, id, version)
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*keys, id, "_version"]]
    return new.alias("n").join(old.alias("o"), same, "left_anti").drop("_version")


def reconciled(requests: DataFrame, prior: DataFrame, progress: DataFrame, rows: DataFrame, identity: list[str], context: str) -> DataFrame:
    """The rows of an earlier run that answer ``requests``, under the new request_id; nothing for those to be asked again.

    A request of ``prior`` is reusable if its marker in ``progress`` (request_id, detections, context) was made in
    ``context`` and counts as many detections as ``rows`` has indices for it, and if none of its ``identity`` is null. It
    answers the requests of equal identity; if several do, the one with the greatest request_id. Zero detections, marked so,
    are an answer too: such a request gives one row with null detection_index.
    """
    held = rows.groupBy("request_id").agg(F.count_distinct("detection_index").alias("_held"))
    marked = progress.filter(F.col("context") == context).select("request_id", "detections").distinct()
    whole = marked.join(held, "request_id", "left").filter(F.col("detections") == F.coalesce("_held", F.lit(0))).select("request_id")
    usable = prior.join(whole, "request_id", "left_semi").dropna(subset=identity)
    best = usable.groupBy(*identity).agg(F.max("request_id").alias("_old"))
    bound = requests.select("request_id", *identity).join(best, identity)
    last = [c for c in rows.columns if c != "request_id"]
    return bound.select("request_id", "_old").join(rows.select(F.col("request_id").alias("_old"), *last), "_old", "left").select("request_id", *last)


def drained(state: DataFrame, pending: Column, step: Callable[[DataFrame], DataFrame], max_rounds: int) -> DataFrame:
    """``state`` after ``step`` was applied to its ``pending`` rows again and again: at most ``max_rounds`` + 1 times.

    Each round is stored in the shared folder and takes only what is still pending; rows that are done are set aside once.
    """
    open_rows = written(state.filter(pending), "pending")
    done = [state.filter(~F.coalesce(pending, F.lit(False)))]
    for _ in range(max_rounds + 1):
        if not open_rows.limit(1).count():
            return _united(done)
        moved = written(step(open_rows), "round")
        discard(open_rows)
        done.append(moved.filter(~F.coalesce(pending, F.lit(False))))
        open_rows = written(moved.filter(pending), "pending")
    return _united([*done, open_rows])


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
