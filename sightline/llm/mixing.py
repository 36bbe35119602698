"""Mixes of sources by iterative proportional fitting.

Documents are counted in tokens of a public tokenizer and summed into cells (source, language, topic). For every mix the
cells' token weights are raked to the marginals wanted: each source's goal (or what its cap allows), and the languages'
and topics' shares in the listed sources. A cell's weight over its size is the expected number of uses of each of its
documents; a document is used the whole part of it, and once more with the rest as probability.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.epoch_sample import draw
from sightline.session import written

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k.tiktoken"

# Spellings of languages; any other becomes 'und'.
LANGUAGES = {
    "en": "en", "eng": "en", "de": "de", "deu": "de", "ger": "de", "fr": "fr", "fra": "fr", "fre": "fr", "es": "es", "spa": "es", "ru": "ru", "rus": "ru",
    "zh": "zh", "zho": "zh", "chi": "zh", "ja": "ja", "jpn": "ja", "th": "th", "tha": "th", "hi": "hi", "hin": "hi", "ar": "ar", "ara": "ar",
}

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The byte-level BPE encoder with the ranks in the file ``path``; kept for the life of the process."""
    if path not in _encoders:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def source_key(c: Column) -> Column:
    """Trimmed and lower-cased; null where nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(c, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")), F.lit(""))


def language_key(c: Column) -> Column:
    primary = F.regexp_extract(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^[a-z]+", 0)
    names = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(names[primary], F.lit("und"))


def topic_key(text: Column) -> Column:
    """One of four broad topics, told by what a text mentions: files, speech, figures, scenes."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike(r"\w+_\d+\.\w{3,4}"), "files").when(t.rlike("[\"“„«「]"), "speech").when(t.rlike(r"\p{Nd}"), "figures").otherwise("scenes")


def sized(documents: DataFrame, topic: Column | None = None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens of every document, stored in the shared folder.

    Null and blank texts have no tokens; documents without a source are left out, as no mix can name them.
    """
    path = tokenizer or os.path.join(TOKENIZER_DIR, TOKENIZER)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t and not t.isspace() else 0 for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch[k] for k in ("doc_id", "source", "lang", "topic")] + [pa.array(n, pa.int64())], names=["doc_id", "source", "lang", "topic", "tokens"])

    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), source_key(F.col("source")).alias("source"), language_key(F.col("lang")).alias("lang"), (topic if topic is not None else topic_key(F.col("text"))).alias("topic"), "text")
    return written(keyed.filter("source is not null").mapInArrow(counted, "doc_id bigint, source string, lang string, topic string, tokens bigint"), "sized")


def rake(cells: pd.DataFrame, rounds: int = 60, tolerance: float = 1e-9) -> pd.DataFrame:
    """Expected uses of the documents of each cell of one mix.

    ``cells``: source, lang, topic, tokens, weight, max_repeats (NaN: no cap); one row at least for each source listed.
    The result adds size (of the source), goal, reachable (goal, or what the cap allows), uses and short: the source has no
    tokens, or the fitted cells of it reach less than its goal. Sources are met exactly; languages and topics as nearly as
    the sources and caps allow.
    """
    c = cells.reset_index(drop=True).copy()
    tokens = c["tokens"].to_numpy(float)
    source, lang, topic = (pd.factorize(c[k].fillna(""))[0] for k in ("source", "lang", "topic"))
    total = lambda key, v: np.bincount(key, v)
    size = total(source, tokens)
    first = np.unique(source, return_index=True)[1]
    weight, cap = c["weight"].to_numpy(float)[first], c["max_repeats"].to_numpy(float)[first]
    cap = np.where(np.isnan(cap), np.inf, cap)
    goal = tokens.sum() * (weight / weight.sum() if weight.sum() > 0 else 0 * weight)
    most = np.where(size > 0, size * np.where(size > 0, cap, 0), 0.0)
    reachable = np.minimum(goal, most)
    held = tokens > 0
    w = np.where(held, tokens, 0.0)
    wanted = {id(k): total(k, tokens) / max(tokens.sum(), 1) * reachable.sum() for k in (lang, topic)}
    limit = np.where(held, tokens * cap[source], 0.0)

    def meet_sources(w: np.ndarray) -> np.ndarray:
        for _ in range(len(w) + 1):  # cells at their cap stay there, the others of the source share the rest
            full = w >= limit * (1 - 1e-12)
            rest = reachable - total(source, np.where(full, limit, 0.0))
            free = total(source, np.where(full, 0.0, w))
            scale = np.divide(np.maximum(rest, 0), free, out=np.ones_like(free), where=free > 0)
            new = np.minimum(np.where(full, limit, w * scale[source]), limit)
            over = total(source, new) > reachable * (1 + 1e-12)
            if over.any():
                back = np.divide(reachable, total(source, new), out=np.ones_like(free), where=total(source, new) > 0)
                new = np.where(over[source], new * back[source], new)
            if np.allclose(new, w, rtol=tolerance, atol=tolerance):
                return new
            w = new
        return w

    for _ in range(rounds):
        before = w
        for key in (lang, topic):
            have = total(key, w)
            w = w * np.divide(wanted[id(key)], have, out=np.ones_like(have), where=have > 0)[key]
        w = meet_sources(np.minimum(w, limit))
        if np.allclose(w, before, rtol=1e-7):
            break
    c["uses"] = np.divide(w, tokens, out=np.zeros_like(w), where=held)
    short = (size <= 0) | (total(source, w) < goal * (1 - 1e-6))  # told by what the fitted cells reach
    c["size"], c["goal"], c["reachable"], c["short"] = size[source], goal[source], reachable[source], short[source]
    return c


_FITTED = "mix_id string, source string, lang string, topic string, tokens bigint, weight double, max_repeats double, uses double, size double, goal double, reachable double, short boolean"


def fit(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """The cells of every mix with their expected uses (see ``rake``).

    Sources are compared trimmed and lower-cased. A source listed twice in one mix has the sum of its weights and the
    larger cap (none if either has none); null, NaN and negative weights count as 0, negative caps as 0; targets without mix or source are left
    out. One mix has at most its listed sources times eleven languages and the topics as cells, and is raked in one task.
    """
    share = F.col("target_share").cast("double")
    weight = F.when((share > 0) & ~F.isnan(share), share).otherwise(0.0)
    listed = (
        targets.select("mix_id", source_key(F.col("source")).alias("source"), weight.alias("w"), F.when(F.col("max_repeats") < 0, 0.0).otherwise(F.col("max_repeats").cast("double")).alias("m"))
        .filter("mix_id is not null and source is not null")
        .groupBy("mix_id", "source")
        .agg(F.sum("w").alias("weight"), F.when(F.count("m") == F.count("*"), F.max("m")).alias("max_repeats"))
    )
    cells = sizes.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    joined = listed.join(cells, "source", "left").select("mix_id", "source", "lang", "topic", F.coalesce("tokens", F.lit(0)).alias("tokens"), "weight", "max_repeats")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return rake(pdf)[[x.split()[0] for x in _FITTED.split(", ")]]

    return joined.groupBy("mix_id").applyInPandas(one, _FITTED)


def members(sizes: DataFrame, fitted: DataFrame, seed: int = 0) -> DataFrame:
    """The documents of every mix with how often each is used: mix_id, doc_id, source, tokens, repeats."""
    joined = sizes.filter("tokens > 0").join(fitted.select("mix_id", "source", "lang", "topic", "uses").filter("uses > 0"), ["source", "lang", "topic"])
    whole = F.floor("uses")
    u = draw(F.concat_ws(":", "mix_id", F.col("doc_id").cast("string")), seed)
    repeats = (whole + (u < F.col("uses") - whole).cast("bigint")).cast("int")
    return joined.withColumn("repeats", repeats).filter("repeats > 0").select("mix_id", "doc_id", "source", "tokens", "repeats")


def report(sizes: DataFrame, fitted: DataFrame, seed: int = 0) -> DataFrame:
    """Each listed source of each mix: its size, goal, the tokens and share reached, and whether it falls short."""
    plan = fitted.groupBy("mix_id", "source").agg(F.max("size").alias("size"), F.max("goal").alias("goal"), F.max("short").alias("short"))
    used = members(sizes, fitted, seed).groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached"))
    whole = used.groupBy("mix_id").agg(F.sum("reached").alias("_all"))
    d = plan.join(used, ["mix_id", "source"], "left").join(whole, "mix_id", "left")
    reached = F.coalesce("reached", F.lit(0))
    share = F.when(F.col("_all") > 0, reached / F.col("_all")).otherwise(0.0)
    return d.select("mix_id", "source", F.col("size").cast("bigint").alias("size"), "goal", reached.alias("reached"), share.alias("share"), "short")
