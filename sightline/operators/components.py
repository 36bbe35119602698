"""Connected components.

Graphs of any size are labelled in rounds: every node takes the least label among its own and its neighbours', and then
its label's label. Only nodes with an edge take part. A round is a join and an aggregation and is stored in the shared
folder, so lineage stays short, a lost executor costs one round at most, and no task or driver holds a graph.

Graphs that fall into many small keyed parts are labelled in one pass: the few edges of a key are folded by relabelling
the larger of two joined sets. Keys of more than ``FOLD_EDGES`` edges go through the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import written

FOLD_EDGES = 2_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (the least node it is joined to) for every node of ``edges`` (a, b). Direction does not count.

    Null ends and loops are left out.
    """
    e = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("n"))
        moved = labels.join(near, labels["node"] == near["a"]).select("node", F.least("component", "n").alias("c"), F.col("component").alias("old"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("further"))
        new = written(moved.join(jump, "c", "left").select("node", F.least("c", F.coalesce("further", "c")).alias("component"), "old"), "labels")
        labels = new.select("node", "component")
        if not new.filter("component <> old").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def keyed_components(edges: DataFrame, keys: list[str], fold_edges: int = FOLD_EDGES) -> DataFrame:
    """keys, node, component for the nodes of ``edges`` (keys, a, b); components never leave their key.

    Keys and ends must not be null.
    """
    stored = written(edges.select(*keys, "a", "b").filter("a <> b"), "edges")
    large = stored.groupBy(*keys).count().filter(F.col("count") > fold_edges).drop("count")
    has_large = large.limit(1).count() > 0
    small = stored.join(large, keys, "left_anti") if has_large else stored
    lists = small.groupBy(*keys).agg(F.collect_list(F.struct("a", "b")).alias("_e"))
    nodes = F.array_distinct(F.concat(F.transform("_e", lambda e: e["a"]), F.transform("_e", lambda e: e["b"])))
    start = F.transform(nodes, lambda n: F.struct(n.alias("node"), n.alias("component")))

    def join(acc, e):
        label = lambda v: F.get(F.filter(acc, lambda x: x["node"] == v), F.lit(0))["component"]
        ends = F.array(F.struct(F.least(label(e["a"]), label(e["b"])).alias("lo"), F.greatest(label(e["a"]), label(e["b"])).alias("hi")))
        relabelled = F.transform(ends, lambda p: F.transform(acc, lambda x: F.struct(x["node"].alias("node"), F.when(x["component"] == p["hi"], p["lo"]).otherwise(x["component"]).alias("component"))))
        return F.get(relabelled, F.lit(0))

    found = lists.select(*keys, F.inline(F.aggregate("_e", start, join)))
    if not has_large:
        return found
    node = lambda c: F.struct(*keys, F.col(c).alias("_v"))
    rest = components(stored.join(large, keys, "left_semi").select(node("a").alias("a"), node("b").alias("b")))
    return found.unionByName(rest.select(*[F.col("node")[k].alias(k) for k in keys], F.col("node")["_v"].alias("node"), F.col("component")["_v"].alias("component")))
