"""Texts cut off before their writer's end, by hashed logistic regression on how texts close.

Intact values of a bounded sample are cut artificially: inside words, after words that never close a text, and at the
lengths where the table's texts pile up (its field limits). The classifier learns from hashed features of the closing
characters and words, the punctuation and the distance to a limit, and then scores every record. Which words are known
and which can close a text is counted over all texts; only the regression is fitted to the sample. Cutting, counting and
fitting run in tasks; the driver hands the fitted weights on.

What counts as cut: the text stops inside a word, inside an open quotation, or on a word that cannot close the phrase,
whatever mark was left at the break. A missing final stop, dots added at the end or a damaged letter are no cut.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import written

BITS = 18
SAMPLE_TEXTS = 6_000  # texts of one table from which the classifier is trained
LIMIT_TIMES, LIMIT_DEVIATIONS = 3, 6  # a field limit is a length that stands out so many times and standard deviations
TAIL_WORDS = 6  # words at the end of a text that its features see, however long they are
#: Shares of a word's occurrences that stand at an end: below the first it cannot close a text, above the second it can.
NEVER_CLOSES, CLOSES = 0.006, 0.01
#: A word is known if it stands inside texts so often, and this share of its occurrences is inside: a piece left by cuts
#: stands at ends only, however many texts there are.
KNOWN_INSIDE, KNOWN_SHARE = 3, 0.02
WORDS_HELD = 200_000  # words that a counting task holds before it hands its counts on

_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_MARK = re.compile(r"(?:\s*(?:\[[^\[\]]{0,14}\]?|\((?:cut|more|truncated|continued)\)?|…|\.{2,}|&[a-z]{0,7};?|\\(?:u[0-9a-fA-F]{0,4}|n|x\w{0,2})?|</?\w{0,8}/?>?))+\s*$", re.I)
_MARK_HINT = re.compile(r"[\[(…&\\<]|\.\.")  # stands in every mark
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_STOP = re.compile(r"[\W_]*$")
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[A-Z\"'(])")


def _class(word: str) -> str:
    return "0" if word.isdigit() else word.lower()


def tidy(text: str) -> tuple[str, str]:
    """The text without blanks and marks of a break at its end, and the kind of mark ('' if none)."""
    if not text.isascii():
        text = _INVISIBLE.sub("", text).replace("\xa0", " ")
    text = text.rstrip()
    left, kind = text, ""
    while True:
        near = max(0, len(left) - 200)  # marks are short; a longer row of them is taken off in turns
        found = _MARK.search(left, near) if _MARK_HINT.search(left, near) else None
        if not found:
            return left, kind
        shorter = left[: found.start()].rstrip()
        if not shorter:
            return text, ""
        left, kind = shorter, "other" if kind == "other" or not set(found.group().strip()) <= set(".…") else "dots"


def _tail(text: str) -> str:
    """The end of ``text`` from the ``TAIL_WORDS``-th blank from its end on."""
    parts = text.rsplit(None, TAIL_WORDS)
    return text[len(parts[0]) :] if len(parts) > TAIL_WORDS else text


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    limits: dict[str, tuple[int, ...]]


def last_word(text: str) -> str:
    """The class of the last word of ``text`` ('' if none), as ``features`` sees it."""
    words = _WORD.findall(_tail(tidy(text)[0]))
    return _class(words[-1]) if words else ""


def _hashed(names: list[str]) -> list[int]:
    return [zlib.crc32(x.encode()) >> (32 - BITS) for x in names]


def closing(text: str, table: str, limits: tuple[int, ...], shown: int | None = None) -> tuple[str, list[int], Callable[[bool], list[int]]]:
    """How ``text`` closes: its last word's class, the hashed features that do not hang on whether this word is known, and
    those that do. ``shown``: the text's length as stored, if it differs."""
    left, mark = tidy(text)
    tail = _tail(left)
    stop = _STOP.search(tail).group().strip()
    words = _WORD.findall(tail)
    last = words[-1] if words else ""
    w = _class(last)
    before = [_class(x) for x in words[-4:-1]]
    p1, p2 = (before[-1] if before else "^"), (before[-2] if len(before) > 1 else "^")
    shape = "U" if len(last) > 1 and last.isupper() else "C" if last[:1].isupper() else "d" if last.isdigit() else "l"
    opened = left.count('"') % 2 == 1
    length = len(text.rstrip()) if shown is None else shown
    near = "at" if length in limits or length + 1 in limits else "no"
    ended = "." if stop[:1] in (".", "!", "?") else '"' if '"' in stop else stop[:1]
    damaged = "�" in last or stop[:1] == "�"
    plain = [f"w={w}", f"p={p1} {w}", f"pp={p2} {p1} {w}", f"ps={p1} {w[-1:]}", f"end={ended}", f"open={opened}", f"openend={opened}{ended}", f"near={near}", f"mark={mark}", f"dam={damaged}", f"{table} end={ended}", f"{table} w={w}"]
    plain += [f"s{k}={shape}{w[-k:]}" for k in range(1, 7) if len(w) >= k]

    def told(known: bool) -> list[int]:
        k = "k" if known or w == "0" else "n"
        out = [f"ks={k}{shape}", f"kse={k}{shape}{ended}", f"pk={p1} {k}", f"neark={near}{k}", f"len={min(len(w), 8)}{k}", f"{table} near={near}{k}"]
        if k == "n":
            out += [f"n{i}={shape}{w[-i:]}" for i in range(2, 6) if len(w) > i]
        return _hashed(out)

    return w, _hashed(plain), told


def features(text: str, table: str, known: frozenset[str] | set[str], limits: tuple[int, ...], shown: int | None = None) -> list[int]:
    """Hashed feature numbers of how ``text`` closes (see ``closing``)."""
    w, plain, told = closing(text, table, limits, shown)
    return plain + told(w in known)


WIDTH = 34


def _matrix(rows: list[list[int]]) -> np.ndarray:
    out = np.full((len(rows), WIDTH), 1 << BITS, np.int32)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r[:WIDTH]
    return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 8, batch: int = 1024, l2: float = 1e-6, seed: int = 0) -> np.ndarray:
    """Weights of a logistic regression over feature numbers, by adaptive gradient steps over shuffled batches."""
    size = (1 << BITS) + 1
    w, h = np.zeros(size), np.full(size, 1e-6)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = order[k : k + batch]
            part = x[rows]
            z = w[part].sum(1)
            g = weight[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows])
            touched, at = np.unique(part, return_inverse=True)
            grad = np.bincount(at.ravel(), np.repeat(g, part.shape[1])) / len(rows) + l2 * w[touched]
            h[touched] += grad * grad
            w[touched] -= 0.15 * grad / np.sqrt(h[touched])
    return w


Counts = dict[str, Counter]  # by what is counted: inside a text, in all, at an end, as a text's last word
_COUNTED = ["inside", "total", "ends", "last"]


def counted(text: str, limits: tuple[int, ...], counts: Counts) -> None:
    """Adds the words of ``text`` to ``counts``. An end is that of an inner sentence or of a text no limit or mark has cut."""
    left, mark = tidy(text)
    parts = [[_class(w) for w in _WORD.findall(part)] for part in _SENTENCE.split(left)]
    whole = [w for part in parts for w in part]
    if not whole:
        return
    counts["inside"].update(whole[:-1])
    counts["total"].update(whole)
    counts["last"][whole[-1]] += 1
    closed = parts if mark != "other" and len(text) not in limits and len(text.rstrip()) not in limits else parts[:-1]
    counts["ends"].update(part[-1] for part in closed if part)


def word_counts(texts: DataFrame, table: str, text: str, limits: dict[str, tuple[int, ...]]) -> DataFrame:
    """word, inside, total, ends, last over all ``texts``, added up in each task before the shuffle."""

    def out(counts: Counts) -> pd.DataFrame:
        return pd.DataFrame([(w, *[counts[c][w] for c in _COUNTED]) for w in counts["total"]], columns=["word", *_COUNTED])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counts = {c: Counter() for c in _COUNTED}
        for batch in batches:
            for name, t in zip(batch["_table"], batch["_text"]):
                counted(t, limits.get(name, ()), counts)
                if len(counts["total"]) >= WORDS_HELD:
                    yield out(counts)
                    counts = {c: Counter() for c in _COUNTED}
        yield out(counts)

    rows = texts.select(F.col(table).alias("_table"), F.col(text).alias("_text"))
    parts = rows.mapInPandas(count, "word string, inside bigint, total bigint, ends bigint, last bigint")
    return parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in _COUNTED])


def is_known(inside: Column, last: Column) -> Column:
    return (inside >= KNOWN_INSIDE) & (inside >= KNOWN_SHARE * (inside + last))


def cut_spots(text: str, limits: tuple[int, ...], seed: int) -> list[int]:
    """Where ``text`` is cut artificially: seven places in its later two thirds, and its table's limits."""
    rng = np.random.default_rng([seed, zlib.crc32(text.encode()), 1])
    return [int(k) for k in rng.integers(max(4, len(text) // 3), max(5, len(text)), size=7)] + [x for x in limits if x < len(text)]


def examples(text: str, table: str, limits: tuple[int, ...], known: frozenset[str], total: dict[str, int], ends: dict[str, int], seed: int = 0) -> tuple[list, list, list]:
    """Features, labels and weights from intact values and their artificial cuts.

    Intact are the inner sentences, and whole texts that stop short of the limits on a word which closes texts elsewhere.
    """
    xs, ys, ws = [], [], []
    rng = np.random.default_rng([seed, zlib.crc32(text.encode())])

    def add(t: str, y: int, weight: float = 1.0, shown: int | None = None) -> None:
        xs.append(features(t, table, known, limits, shown))
        ys.append(y)
        ws.append(weight)

    def closing(word: str) -> int | None:
        """1: cannot close, 0: can close, None: not known."""
        c = _class(word)
        n = total.get(c, 0)
        if n < 12:
            return None
        rate = ends.get(c, 0) / n
        return 1 if rate < NEVER_CLOSES else 0 if rate > CLOSES else None

    def intact(t: str) -> bool:
        words = _WORD.findall(_tail(t))
        return bool(words) and t.count('"') % 2 == 0 and closing(words[-1]) == 0 and len(t) not in limits

    t = tidy(text)[0]
    whole = [m.start() for m in _SENTENCE.finditer(t)]
    closed = [len(t)] if intact(t) else []
    stops = whole + closed
    if not stops:
        return xs, ys, ws
    for stop in sorted({stops[int(k)] for k in rng.integers(len(stops), size=2)} | set(closed)):
        s = t[:stop]
        bare = re.sub(r"[.!?]+$", "", s)
        add(s, 0)
        add(bare, 0)
        kind = rng.integers(5)
        if kind == 0:
            add(bare + str(rng.choice(["...", "…", " ..."])), 0)
        elif kind == 1 and len(bare) > 3:
            k = len(bare) - 1 - int(rng.integers(3))
            add(bare[:k] + "�" + bare[k + 1 :], 0, 0.5)
        elif kind == 2:
            add(bare + str(rng.choice([",", ";"])), 0, 0.5)
    for k in cut_spots(t, limits, seed):
        cut = t[:k]
        words = _WORD.findall(_tail(cut))
        if not words or k >= len(t):
            continue
        inside = cut[-1:].isalnum() and t[k : k + 1].isalnum()
        quoted = cut.count('"') % 2 == 1
        capital = words[-1][:1].isupper()
        label = 1 if inside or quoted else closing(words[-1])
        weight = 1.0
        if label is None and capital:
            label, weight = 0, 0.5
        if label is None:
            continue
        if label == 0 and not inside:
            weight = 0.5
        shown = k if k in limits else None
        add(cut + (str(rng.choice([" ...", "…", " [...]", "..."])) if rng.random() < 0.15 else ""), label, weight, shown)
    return xs, ys, ws


def field_limits(texts: DataFrame, text: str, table: str) -> dict[str, tuple[int, ...]]:
    """For each table every length at which far more texts stop than at the lengths around them.

    A length stands out if its count is ``LIMIT_TIMES`` what is usual around it and ``LIMIT_DEVIATIONS`` standard deviations
    of a count above that. The lengths of all texts are counted in tasks.
    """
    counted = texts.filter(F.col(text).isNotNull()).groupBy(F.col(table).alias("t"), F.length(text).alias("n")).count().filter("n > 0")
    around = Window.partitionBy("t").orderBy("n").rangeBetween(-6, 6)
    usual = (F.sum("count").over(around) - F.col("count")) / 12
    excess = counted.withColumn("usual", usual).filter((F.col("count") >= LIMIT_TIMES * F.col("usual")) & (F.col("count") - F.col("usual") >= LIMIT_DEVIATIONS * F.sqrt(F.col("usual") + 1)))
    out: dict[str, list[int]] = {}
    for r in excess.select("t", "n").collect():
        out.setdefault(r["t"], []).append(r["n"])
    return {t: tuple(sorted(v)) for t, v in out.items()}


def fit(sample: DataFrame, words: DataFrame, limits: dict[str, tuple[int, ...]], seed: int = 0) -> Model:
    """A model from the sampled texts (_table, _text) and what is known of their words from all texts.

    The examples are made in tasks, each text's by random numbers of its own; one task fits them, in the order of the texts.
    """
    spark = sample.sparkSession

    def ending(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every word that the sampled texts or their artificial cuts end on."""
        for batch in batches:
            out: set[str] = set()
            for name, raw in zip(batch["_table"], batch["_text"]):
                t = tidy(raw)[0]
                out.update(_class(w) for w in _WORD.findall(t))
                out.update(last_word(t[:k]) for k in cut_spots(t, limits.get(name, ()), seed))
            yield pd.DataFrame([(w,) for w in sorted(out)], columns=["word"])

    asked = sample.mapInPandas(ending, "word string").distinct()
    told = words.filter("known or total >= 12").join(asked, "word", "left_semi").select("word", "known", "total", "ends").collect()  # of the sample's words only
    facts = spark.sparkContext.broadcast((frozenset(r["word"] for r in told if r["known"]), {r["word"]: r["total"] for r in told}, {r["word"]: r["ends"] for r in told}))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total, ends = facts.value
        for batch in batches:
            rows = []
            for t, text in zip(batch["_table"], batch["_text"]):
                parts = examples(text, t, limits.get(t, ()), known, total, ends, seed)
                rows += [(t, zlib.crc32(text.encode()), k, *one) for k, one in enumerate(zip(*parts))]
            yield pd.DataFrame(rows, columns=["t", "number", "k", "x", "y", "w"])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y, w = [np.zeros((0, WIDTH), np.int32)], [np.zeros(0)], [np.zeros(0)]
        for batch in batches:
            x.append(_matrix(batch["x"].tolist()))
            y.append(batch["y"].to_numpy(float))
            w.append(batch["w"].to_numpy(float))
        yield pd.DataFrame({"weights": [train(np.concatenate(x), np.concatenate(y), np.concatenate(w)).tobytes()]})

    made = sample.mapInPandas(make, "t string, number bigint, k int, x array<int>, y double, w double")
    fitted = made.repartition(1).sortWithinPartitions("t", "number", "k").mapInPandas(learn, "weights binary").first()
    return Model(np.frombuffer(bytes(fitted["weights"])) if fitted else np.zeros((1 << BITS) + 1), limits)


def scores(texts: list[str | None], tables: list[str], model: Model) -> pd.DataFrame:
    """For each text its last word and the log-odds of its being cut, if that word is known and if it is not; null and
    blank texts have minus infinity."""
    rows, last = [], []
    for t, table in zip(texts, tables):
        if not t or not t.strip():
            rows += [[], []]
            last.append(None)
            continue
        w, plain, told = closing(t, table, model.limits.get(table, ()))
        rows += [plain + told(True), plain + told(False)]
        last.append(w or None)
    z = model.weights[_matrix(rows)].sum(1) if rows else np.zeros(0)
    z = np.where([not r for r in rows], -np.inf, z)
    return pd.DataFrame({"last": last, "known": z[0::2], "unknown": z[1::2]})


def prepared(texts: DataFrame, table: str, text: str, sample_texts: int = SAMPLE_TEXTS) -> tuple[Model, DataFrame]:
    """The fitted model and the stored words of all distinct texts (word, inside, total, ends, last, known).

    Of every table the ``sample_texts`` texts with the least hash are the sample.
    """
    limits = field_limits(texts, text, table)
    once = written(texts.filter(F.length(F.trim(text)) > 0).select(F.col(table).alias("_table"), F.col(text).alias("_text")).distinct(), "texts")
    words = written(word_counts(once, "_table", "_text", limits).withColumn("known", is_known(F.col("inside"), F.col("last"))), "words")
    least = Window.partitionBy("_table").orderBy(F.xxhash64(F.lit(0), "_text"), "_text")
    sample = once.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= sample_texts).drop("_n")
    spread = once.sparkSession.sparkContext.defaultParallelism
    return fit(written(sample.repartition(spread, "_text"), "sample"), words, limits), words


def score_all(texts: DataFrame, table: str, text: str, sample_texts: int = SAMPLE_TEXTS, fitted: tuple[Model, DataFrame] | None = None) -> DataFrame:
    """``texts`` with ``cut_score`` (log-odds) and ``cut`` (score over 0) for every row; extra columns stay.

    Null and blank texts are not cut. With nothing to train from no text is. Words are counted over all distinct texts of
    a table; the list of known words is joined to the last words, so its length may grow with the texts. Without
    ``fitted`` (see ``prepared``) the counting and fitting run when this is called.
    """
    fitted_model, words = fitted or prepared(texts, table, text, sample_texts)
    model = texts.sparkSession.sparkContext.broadcast(fitted_model)

    @F.pandas_udf("last string, known double, unknown double")
    def score(t: pd.Series, n: pd.Series) -> pd.DataFrame:
        return scores(t.tolist(), n.tolist(), model.value)

    listed = words.filter("known").select(F.col("word").alias("_last"), F.lit(True).alias("_listed"))
    own = [c for c in texts.columns if c not in ("cut_score", "cut")]
    seen = texts.select(F.struct(*own).alias("_row"), score(F.col(text), F.col(table)).alias("_z")).withColumn("_last", F.col("_z.last"))
    told = seen.join(listed, "_last", "left").select("_row.*", F.when(F.coalesce("_listed", F.lit(False)), F.col("_z.known")).otherwise(F.col("_z.unknown")).alias("cut_score"))
    return told.withColumn("cut", F.col("cut_score") > 0)
