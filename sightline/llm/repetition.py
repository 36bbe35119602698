"""Repetition inside a text: a learned decision list names texts with too much of it, and an exact count confirms them.

Cheap statistics of every text are Spark expressions: how many of its words, pairs of words and clauses are distinct. A
decision list is learned from labelled statistics of a bounded sample by sequential covering: a rule, a conjunction of
thresholds, is grown on two thirds of the sample by information gain, pruned on the rest, and what it covers is taken
out; then the next rule follows. The list becomes one ordered conditional expression over the statistics of all texts.
The share of repeated words itself is no statistic of the list; it is measured only where the list says so.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import sample_rows

RUN = 3  # words that must recur together
LIMIT = 0.3  # share of repeated words from which a text has too much of them
SAMPLE_TEXTS = 6_000  # texts from which the list is learned; each gives one more with repeats planted
STATISTICS = ["distinct_words", "distinct_pairs", "distinct_clauses", "n_words"]

_TAG, _INVISIBLE = r"<[^<>]*>|&#?[A-Za-z0-9]+;", r"[\p{Cf}\x{34f}\x{fe00}-\x{fe0f}]"
_CLAUSE_ENDS = r"[\p{Po}\n]+"


def words_of(text: Column) -> Column:
    """The words of ``text``: lower-cased, without tags, invisible characters and punctuation; every number is '0'."""
    c = F.regexp_replace(F.coalesce(text, F.lit("")), F.lit(_TAG), F.lit(" "))
    c = F.lower(F.regexp_replace(c, F.lit(_INVISIBLE), F.lit("")))
    c = F.regexp_replace(c, F.lit(r"\p{N}+(?:[.,:]\p{N}+)*"), F.lit("0"))
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _share(top: Column, bottom: Column, default: float) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(default))


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` as ``_row`` with the words of ``text`` and its ``STATISTICS``: what the list decides on.

    distinct_words, distinct_pairs, distinct_clauses: how large a share of the words, of the pairs of neighbouring words
    and of the clauses (what stands between punctuation) is distinct; 1 where there are none.
    """
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), words_of(F.col(text)).alias("_words"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    parts = F.filter(F.transform(F.split("_low", _CLAUSE_ENDS), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size("_words")
    pairs = F.transform(F.slice("_words", 2, F.greatest(n - 1, F.lit(0))), lambda w, i: F.xxhash64(F.get("_words", i), w))
    d = d.select("_row", "_words", n.alias("_n"), pairs.alias("_pairs"), parts.alias("_parts"))
    statistics = {
        "distinct_words": _share(F.size(F.array_distinct("_words")), F.col("_n"), 1.0),
        "distinct_pairs": _share(F.size(F.array_distinct("_pairs")), F.size("_pairs"), 1.0),
        "distinct_clauses": _share(F.size(F.array_distinct("_parts")), F.size("_parts"), 1.0),
        "n_words": F.col("_n").cast("double"),
    }
    # The generator of one row keeps later filters above it; pushed below, they would compute the lists once per use.
    return d.select("_row", F.inline(F.array(F.struct("_words", *[v.alias(k) for k, v in statistics.items()]))))


def with_repeated_share(d: DataFrame, words: str, where: Column) -> DataFrame:
    """``d`` with repeated_share: the share of ``words`` that lie in a run of three or more words that stood earlier.

    Runs may overlap; the first occurrence does not count; 0 for fewer than four words. Measured only ``where``, else null.
    The runs are found by sorting (run hash, position), so long texts cost n log n.
    """
    last = F.size(words) - RUN
    run_hash = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN)])
    d = d.withColumn("_measured", where)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(run_hash(i).alias("h"), i.alias("i")))
    d = d.withColumn("_sorted", F.when(F.col("_measured") & (last >= 0), F.sort_array(runs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    again = F.transform("_sorted", lambda x, k: F.when((k > 0) & (F.get("_sorted", k - 1)["h"] == x["h"]), x["i"]))
    d = d.withColumn("_again", F.sort_array(F.array_compact(again)))
    covered = F.aggregate(
        "_again",
        F.struct(F.lit(0).alias("n"), F.lit(-RUN).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(RUN), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )
    # Exploded from a list of one, so that filters on the share stay above the lists, which they would compute anew per run.
    share = F.when(F.col("_measured"), _share(covered, F.size(words), 0.0))
    return d.withColumn("repeated_share", F.explode(F.array(share))).drop("_measured", "_sorted", "_again")


def shares(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the repeated_share of every text (see ``with_repeated_share``); a column of that name is replaced."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != "repeated_share"]
    d = df.select(F.struct(*kept).alias("_row"), words_of(F.col(text)).alias("_words"))
    return with_repeated_share(d, "_words", F.lit(True)).select("_row.*", "repeated_share")


def plain_share(words: list[str]) -> float:
    """The repeated share by comparing runs one by one; labels the sample and checks the expressions."""
    seen: set[tuple[str, ...]] = set()
    hit = [False] * len(words)
    for i in range(len(words) - RUN + 1):
        run = tuple(words[i : i + RUN])
        if run in seen:
            hit[i : i + RUN] = [True] * RUN
        seen.add(run)
    return sum(hit) / len(words) if len(words) else 0.0


@dataclass(frozen=True)
class Condition:
    column: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.column] >= self.threshold if self.at_least else x[self.column] < self.threshold


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray) -> tuple[float, Condition] | None:
    """The threshold with the greatest information gain for the positives; it lies midway between two neighbours."""
    p, n = y.sum(), (~y).sum()
    before = math.log2(p / (p + n))
    best: tuple[float, Condition] | None = None
    for name, v in x.items():
        order = np.argsort(v, kind="stable")
        s, t = v[order], y[order]
        cut = np.flatnonzero(s[1:] > s[:-1]) + 1
        if not len(cut):
            continue
        pos_below = np.concatenate([[0], np.cumsum(t)])[cut]
        for at_least in (True, False):
            pp = p - pos_below if at_least else pos_below
            size = len(v) - cut if at_least else cut
            gain = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1e-9) / size) - before), -1.0)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), Condition(name, at_least, float((s[cut[k]] + s[cut[k] - 1]) / 2)))
    return best if best and best[0] > 1e-9 else None


def learn(x: dict[str, np.ndarray], y: np.ndarray, max_rules: int = 8, seed: int = 0) -> list[Rule]:
    """An ordered list of rules for the positives of ``y``; empty if there are none."""
    rng = np.random.default_rng(seed)
    left = np.ones(len(y), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules and (y & left).any():
        idx = np.flatnonzero(left)
        grow = rng.random(len(idx)) < 2 / 3
        if not y[idx[grow]].any():
            grow[:] = True
        part = lambda rows: ({k: v[rows] for k, v in x.items()}, y[rows])
        gx, gy = part(idx[grow])
        rule: Rule = ()
        while (~gy).any() and (found := _best_condition(gx, gy)):
            rule += (found[1],)
            keep = found[1].holds(gx)
            gx, gy = {k: v[keep] for k, v in gx.items()}, gy[keep]
        px, py = part(idx[~grow]) if (~grow).any() else part(idx)

        def worth(r: Rule) -> float:
            c = _covered(r, px)
            return (py[c].sum() - (~py[c]).sum()) / max(1, c.sum()) if c.any() else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _covered(rule, x) & left
        if not rule or not (hit & y).any() or (hit & ~y).sum() > (hit & y).sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def as_expression(rules: list[Rule]) -> Column:
    """The ordered conditional expression: number of the first rule that holds, from 1; 0 if none does."""
    out: Column | None = None
    for k, rule in enumerate(rules, 1):
        test = F.lit(True)
        for c in rule:
            test &= F.col(c.column) >= c.threshold if c.at_least else F.col(c.column) < c.threshold
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def planted(text: str, rng: np.random.Generator) -> str | None:
    """``text`` with its last words said again between one and a few times; null if it has too few."""
    w = text.split()
    if len(w) < RUN:
        return None
    k = int(rng.integers(RUN, min(len(w), 12) + 1))
    return " ".join(w + w[-k:] * int(rng.integers(1, 7)))


def labelled_sample(spark: SparkSession, sampled: list[str], seed: int = 0) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and labels of the sampled texts and of one copy of each with repeats planted.

    Positive from 30 % repeated words, counted run by run over the words of ``words_of``. The planted repeats give positives
    and near misses whatever the sample holds. Words stay in the tasks; numbers come to the driver.
    """
    rng = np.random.default_rng(seed)
    texts = sampled + [t for t in (planted(x, rng) for x in sampled) if t]

    @F.pandas_udf("boolean")
    def positive(words: pd.Series) -> pd.Series:
        return words.map(lambda w: plain_share(list(w)) >= LIMIT)

    slices = max(1, min(spark.sparkContext.defaultParallelism, len(texts) // 200))
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(slices)
    rows = with_statistics(df, "t").select(*STATISTICS, positive("_words").alias("y")).collect()
    return {name: np.array([float(r[name]) for r in rows]) for name in STATISTICS}, np.array([r["y"] for r in rows], bool)


def fit(texts: DataFrame, text: str, sample_size: int = SAMPLE_TEXTS) -> list[Rule]:
    """A list learned from at most ``sample_size`` distinct texts; it can be kept and given to ``judge``."""
    sampled = [r[0] for r in sample_rows(texts.select(F.col(text).alias("_t")).filter("_t is not null"), ["_t"], sample_size)]
    return learn(*labelled_sample(texts.sparkSession, sampled)) if sampled else []


def judge(texts: DataFrame, text: str, sample_size: int = SAMPLE_TEXTS, rules: list[Rule] | None = None) -> DataFrame:
    """``texts`` with ``STATISTICS``, ``rule`` (0: none), ``repeated_share`` (null where no rule holds) and ``repetitive``.

    A text is repetitive if a rule of the list covers it and its share, then measured, confirms it. Without ``rules`` the
    list is learned first, by jobs that run when this is called. Null and empty texts are not repetitive; repeated rows are
    judged alike; an empty table gives an empty one. Columns of these names are replaced, all others stay.
    """
    rules = fit(texts, text, sample_size) if rules is None else rules
    own = {*STATISTICS, "rule", "repeated_share", "repetitive"}
    kept = [F.col(f"_row.`{c}`").alias(c) for c in texts.columns if c not in own]
    d = with_repeated_share(with_statistics(texts, text).withColumn("rule", as_expression(rules)), "_words", F.col("rule") > 0)
    return d.select(*kept, *STATISTICS, "rule", "repeated_share", F.coalesce(F.col("repeated_share") >= LIMIT, F.lit(False)).alias("repetitive"))
