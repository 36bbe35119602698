"""Evaluation passages inside training documents, by a distributed positional inverted index.

The documents are tokenised once, column by column in Arrow, and their postings (term, document, positions) are stored in
the shared folder, one term-sorted segment per task. Terms are 64-bit hashes; those that no passage can use, told by a bit
field of fixed size, are not stored. Passages are looked up from their rarest terms: each window of a passage gives its
two rarest positions, whose posting lists must meet at one offset-adjusted place, and each whole passage gives so many of
its rarest positions that a document with four fifths of it must hold several of them. What survives is matched in full
from the postings: the longest exact phrase, and the longest part of the passage in order.

Passages are handled in blocks of bounded size over the one index, so what is sent to every task does not grow with their
number.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import written

WORDS, LETTERS = 10, 20  # length of an exact run, in words or, for Chinese, letters
SHARE = 0.8  # of the passage's words, in their order
BLOCK_CHARS = 2_000_000  # characters of passages in one block
FIELD_BITS = 24  # the bit field has 2 ** FIELD_BITS bits

_TAG = r"<[^<>]*>|&#?[\p{L}\p{N}_]{1,10};"
_INVISIBLE = r"[\p{Cf}\x{34f}\x{fe00}-\x{fe0f}]+"
_SINGLE = r"([\p{Han}\p{Hiragana}\p{Katakana}])"
_BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


def token_lists(texts: pa.Array) -> pa.ListArray:
    """The words of each text, and for Chinese and Japanese single letters, without case, punctuation, markup and invisible
    characters; equal up to Unicode form. Null and empty texts have none (or one empty word)."""
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    t = pc.replace_substring_regex(t, _TAG, " ")
    t = pc.utf8_normalize(pc.replace_substring_regex(t, _INVISIBLE, ""), form="NFKC")
    t = pc.utf8_lower(t)
    for sharp, plain in (("ß", "ss"), ("ς", "σ")):  # letters that case alone does not bring together
        t = pc.replace_substring(t, sharp, plain)
    t = pc.utf8_normalize(t, form="NFKC")
    t = pc.replace_substring_regex(pc.replace_substring_regex(t, _SINGLE, r" \1 "), _BETWEEN, " ")
    return pc.split_pattern(pc.utf8_trim(t, " "), " ")


def tokens(text: str | None) -> list[str]:
    """``token_lists`` of one text."""
    return [w for w in token_lists(pa.array([text], pa.string()))[0].as_py() if w]


def term_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of ``words``, each distinct one hashed once."""
    import pandas as pd

    coded = words.dictionary_encode()
    known = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False).view(np.int64)
    return known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.int64)


def field_places(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - FIELD_BITS)).astype(np.int64)


@dataclass
class Passage:
    items: list[str]
    terms: list[int]
    run: int
    at: dict[int, list[int]] = field(default_factory=dict)  # term: its positions, descending
    windows: list[tuple[int, ...]] = field(default_factory=list)  # rarest positions of each window
    rarest: frozenset[int] = frozenset()
    needed: int = 1

    def choose(self, frequency: dict[int, int]) -> None:
        """Fixes the positions from which the passage is looked up, given the terms' document frequencies."""
        n = len(self.terms)
        order = sorted(range(n), key=lambda q: (frequency.get(self.terms[q], 0), q))
        rank = {q: k for k, q in enumerate(order)}
        self.windows = sorted({tuple(sorted(sorted(range(s, s + self.run), key=rank.__getitem__)[:2])) for s in range(n - self.run + 1)})
        missing = n - -(-n * 4 // 5)  # positions that a document with four fifths may lack
        self.needed = min(3, n - missing)
        self.rarest = frozenset(order[: missing + self.needed])


def passages_of(rows: list[tuple[str, str]]) -> list[Passage]:
    """The distinct passages of (item, passage) rows. Passages without words are left out."""
    found: dict[tuple[int, ...], Passage] = {}
    rows = sorted(rows, key=lambda r: (r[0] or "", r[1] or ""))
    lists = token_lists(pa.array([text for _, text in rows], pa.string()))
    flat = lists.flatten()
    hashes, words = term_hashes(flat), flat.to_pylist()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
    for (item, _), start, end in zip(rows, [0, *ends], ends):
        own = words[start:end]
        if not any(own):
            continue
        key = tuple(hashes[start:end].tolist())
        han = sum(len(w) == 1 and "㐀" <= w <= "鿿" for w in own)
        p = found.setdefault(key, Passage([], list(key), LETTERS if 2 * han > len(own) else WORDS))
        p.items.append(item)
    for p in found.values():
        for q in range(len(p.terms) - 1, -1, -1):
            p.at.setdefault(p.terms[q], []).append(q)
    return list(found.values())


def aligned(p: Passage, postings: dict[int, list[int]]) -> bool:
    """Whether a document with these postings can hold a window of ``p`` exactly or four fifths of it in order."""
    if sum(p.terms[q] in postings for q in p.rarest) >= p.needed:
        return True
    for window in p.windows:
        a = window[0]
        if p.terms[a] not in postings:
            continue
        starts = {x - a for x in postings[p.terms[a]]}
        for q in window[1:]:
            starts &= {x - q for x in postings.get(p.terms[q], ())}
        if starts:
            return True
    return False


def match(p: Passage, sequence: list[tuple[int, int]]) -> tuple[int, float]:
    """Longest exact run and greatest share in order of ``p`` in a document's (position, term) pairs, sorted."""
    longest, before, runs = 0, -2, {}
    tails: list[int] = []
    for at, term in sequence:
        spots = p.at.get(term)
        if spots is None:
            continue
        last = runs if at == before + 1 else {}
        runs, before = {q: last.get(q - 1, 0) + 1 for q in spots}, at
        longest = max(longest, max(runs.values()))
        for q in spots:  # descending, so that one place of the document is used once
            k = bisect_left(tails, q)
            tails[k : k + 1] = [q]
    return longest, len(tails) / len(p.terms)


_INDEX = "term bigint, row_no bigint, doc_id bigint, positions array<int>"


def postings(row_no: pa.Array, doc_id: pa.Array, text: pa.Array, wanted: np.ndarray) -> pa.RecordBatch:
    """Postings of the texts' terms whose bit is set in ``wanted`` (packed bits)."""
    lists = token_lists(text)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(flat)) - starts[row]
    term = term_hashes(flat)
    place = field_places(term)
    held = ((wanted[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool) & (pc.binary_length(flat).to_numpy() > 0)
    row, at, term = row[held], at[held], term[held]
    order = np.lexsort((at, term, row))
    row, at, term = row[order], at[order].astype(np.int32), term[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])])) if len(row) else np.zeros(0, np.int64)
    positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(at, pa.int32()))
    rows = pa.array(row[first])
    return pa.record_batch([pa.array(term[first]), row_no.take(rows), doc_id.take(rows), positions], names=["term", "row_no", "doc_id", "positions"])


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive parts of about ``limit`` bytes of text, so that a few very long texts stand alone."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy().astype(np.int64)
    part = np.cumsum(sizes) // limit
    starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(batch)]
    for a, z in zip(starts, starts[1:]):
        if z > a:
            yield batch.slice(a, z - a)


def build_index(documents: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Stored postings of the terms in the bit field: term, row_no, doc_id, positions. Rows are told apart by row_no."""
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(wanted, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                yield postings(part["row_no"], part["doc_id"], part["text"], shared.value)

    rows = documents.filter("text is not null").select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(rows.mapInArrow(run, _INDEX).sortWithinPartitions("term"), "postings")


class Postings:
    """The gathered postings of a batch of documents, read row by row without building nested Python values."""

    def __init__(self, lists: pa.ListArray) -> None:
        self.rows = lists.offsets.to_numpy()
        self.terms = lists.values.field("term").to_numpy()
        positions = lists.values.field("positions")
        self.starts, self.at = positions.offsets.to_numpy(), positions.values.to_numpy()

    def held(self, row: int) -> dict[int, list[int]]:
        lo, hi = self.rows[row], self.rows[row + 1]
        cuts = self.starts[lo : hi + 1].tolist()
        at = self.at[cuts[0] : cuts[-1]].tolist()
        return {t: at[a - cuts[0] : z - cuts[0]] for t, a, z in zip(self.terms[lo:hi].tolist(), cuts, cuts[1:])}


def find_block(index: DataFrame, passages: list[Passage]) -> DataFrame:
    spark = index.sparkSession
    used = spark.createDataFrame([(t,) for t in sorted({t for p in passages for t in p.terms})], "term bigint")
    counted = index.join(F.broadcast(used), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    frequency = {r["term"]: r["n"] for r in counted.collect()}  # terms of the block only
    for p in passages:
        p.choose(frequency)
    lookup: dict[int, set[int]] = {}  # term: passages that are looked up by it
    for k, p in enumerate(passages):
        for q in {*p.rarest, *(q for w in p.windows for q in w)}:
            lookup.setdefault(p.terms[q], set()).add(k)
    shared = spark.sparkContext.broadcast((passages, lookup))
    anchors = spark.createDataFrame([(t,) for t in sorted(lookup)], "term bigint")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages, lookup = shared.value
        for batch in batches:
            rows_out: list[int] = []
            numbers: list[list[int]] = []
            gathered = Postings(batch["postings"])
            for k, row in enumerate(batch["row_no"].to_pylist()):
                held = gathered.held(k)
                hits = [q for q in sorted({q for t in held for q in lookup.get(t, ())}) if aligned(passages[q], held)]
                if hits:
                    rows_out.append(row)
                    numbers.append(hits)
            yield pa.record_batch([pa.array(rows_out, pa.int64()), pa.array(numbers, pa.list_(pa.int32()))], names=["row_no", "passages"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages, _ = shared.value
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            gathered = Postings(batch["postings"])
            for row, (doc, numbers) in enumerate(zip(batch["doc_id"].to_pylist(), batch["passages"].to_pylist())):
                held = gathered.held(row)
                for k in numbers:
                    p = passages[k]
                    longest, share = match(p, sorted((at, t) for t in p.at if t in held for at in held[t]))
                    if longest >= p.run or share >= SHARE - 1e-12:
                        for item in p.items:
                            for column, value in zip(out, (doc, item, longest, share)):
                                column.append(value)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.float64())], names=["doc_id", "item_id", "longest_run", "ordered_share"])

    together = F.collect_list(F.struct("term", "positions")).alias("postings")  # bounded by one document
    by_anchor = index.join(F.broadcast(anchors), "term", "left_semi").groupBy("row_no").agg(together)
    survivors = written(by_anchor.mapInArrow(candidates, "row_no bigint, passages array<int>"), "candidates")
    whole = index.join(survivors, "row_no").groupBy("row_no", "doc_id", "passages").agg(together)
    return whole.mapInArrow(verified, "doc_id bigint, item_id string, longest_run int, ordered_share double")


def find_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Every document with a passage of ``items``: doc_id, item_id, longest_run, ordered_share (best of repeated rows).

    A document holds a passage if it has ten successive words of it (twenty letters for Chinese), or at least four fifths
    of its words in their order. Null and empty texts and passages match nothing; items with one passage are all named.
    """
    spark = documents.sparkSession
    told = items.filter("item_id is not null and passage is not null").select("item_id", "passage").distinct()
    chars = told.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    block = lambda b: passages_of([tuple(r) for r in told.filter(F.pmod(F.xxhash64("passage"), F.lit(blocks)) == b).collect()])
    wanted = np.zeros(1 << FIELD_BITS, bool)
    passages: list[Passage] = []
    for b in range(blocks):  # one block is held at a time
        passages = block(b)
        wanted[field_places(np.array([t for p in passages for t in p.at], np.int64))] = True
    found = spark.createDataFrame([], "doc_id bigint, item_id string, longest_run int, ordered_share double")
    if wanted.any():
        index = build_index(documents, wanted)
        for b in range(blocks):
            passages = passages if blocks == 1 else block(b)
            if passages:
                found = found.unionByName(find_block(index, passages))
    return found.groupBy("doc_id", "item_id").agg(F.max("longest_run").alias("longest_run"), F.max("ordered_share").alias("ordered_share"))


def plain_leaks(documents: list[tuple[int, str]], items: list[tuple[str, str]]) -> set[tuple[int, str]]:
    """Brute force for tests: every document against every passage."""
    passages = passages_of(items)
    out = set()
    for doc, text in documents:
        words = tokens(text)
        sequence = list(enumerate(term_hashes(pa.array(words, pa.string())).tolist()))
        for p in passages:
            longest, share = match(p, sequence)
            if longest >= p.run or share >= SHARE - 1e-12:
                out |= {(doc, item) for item in p.items}
    return out
