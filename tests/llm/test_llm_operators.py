"""Each operator against brute force, and on the cases its docstring defines."""

import math
import random
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sightline.llm import epoch_sample, leakage, mixing, repetition, sentences, term_counts, topn, truncation

# --- repetition


def _shares(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 5.0) for i, t in enumerate(texts)], "id int, text string, _words string, repeated_share double")
    return {r["id"]: r for r in repetition.shares(df, "text").collect()}


def test_repeated_share_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "b", "cat", "Dog", "12", "7.5", "é", "<b>", "x-y", "हिन्दी", "में"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [None, "", "  \n\t", "one", "a a a a a a", "1 2 3 4 5 6", "The cat sat. the CAT sat!", "q​q r s qq r s"]
    got = _shares(spark, texts)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in df.select("id", repetition.words_of(F.col("text")).alias("w")).collect():
        assert math.isclose(got[r["id"]]["repeated_share"], repetition.plain_share(r["w"])), texts[r["id"]]
    assert got[len(texts) - 1]["_words"] == "x"  # a column of a clashing name stays


def test_words_keep_their_marks_and_lose_tags(spark):
    df = spark.createDataFrame([("हिन्दी में <b>Two</b> 7.5 x-y&nbsp;q​q",)], "t string")
    assert df.select(repetition.words_of(F.col("t"))).first()[0] == ["हिन्दी", "में", "two", "0", "x", "y", "qq"]


def test_runs_may_overlap(spark):
    got = _shares(spark, ["a a a a a a", "b c d b c d", "b c d x b c"])
    assert [round(got[i]["repeated_share"], 4) for i in range(3)] == [round(5 / 6, 4), 0.5, 0.0]


def test_very_long_text(spark):
    word = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    long = " ".join(word(i) for i in range(60_000)) + " b c d"
    assert math.isclose(_shares(spark, [long])[0]["repeated_share"], 3 / 60_003)


def test_decision_list_separates_and_prunes():
    x = {"a": np.array([0.1, 0.2, 0.3, 0.7, 0.8, 0.9] * 20), "b": np.arange(120.0)}
    y = x["a"] > 0.5
    rules = repetition.learn(x, y)
    assert len(rules) == 1 and rules[0][0].column == "a" and 0.3 < rules[0][0].threshold < 0.7
    assert repetition.learn(x, np.zeros(120, bool)) == []


def test_judge_names_repetitive_texts_and_keeps_columns(spark):
    rows = [(i, f"the plain text number {i} about a chair and one lamp near door {i * 7}", "k", "z") for i in range(60)]
    rows += [(100, "go home now " * 9, "k", "z"), (101, None, None, "z"), (102, "", "k", "z"), (100, "go home now " * 9, "k", "z")]
    df = spark.createDataFrame(rows, "id int, text string, rule string, _row string")
    out = repetition.judge(df, "text")
    assert [r["id"] for r in out.filter("repetitive").collect()] == [100, 100]
    assert out.count() == len(rows) and {r["_row"] for r in out.collect()} == {"z"}
    assert repetition.judge(df.limit(0), "text").count() == 0


def test_the_list_alone_finds_held_out_repeats(spark, data):
    """Learned on one half of the texts, without the share itself: recall and precision on the other half."""
    from sightline.llm import queries

    texts = [r[0] for r in queries._texts(spark, data).select("text").filter("text is not null").distinct().orderBy("text").collect()]
    learned = repetition.labelled_sample(spark, texts[::2], seed=1)
    x, y = repetition.labelled_sample(spark, texts[1::2], seed=2)
    rules = repetition.learn(*learned)
    assert rules and all(c.column != "repeated_share" for r in rules for c in r)
    hit = sum(repetition._covered(r, x) for r in rules) > 0
    assert (hit & y).sum() >= 0.95 * y.sum() and (hit & y).sum() >= 0.95 * hit.sum() and 20 < y.sum() < len(y)


# --- top N


def _brute_top(rows, groups, n):
    falling = lambda x: (x is None or x != x, -x if x is not None and x == x else 0)
    key = lambda r: (falling(r[2]), falling(r[3]), r[1])
    out = []
    for g in groups:
        mine = sorted([r for r in rows if r[0] == g], key=key)[:n]
        out += [(g, k, r[1]) for k, r in enumerate(mine, 1)]
    return sorted(out)


def test_top_n_with_a_hot_group_ties_nulls_and_nan(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 300)}", f"r{i:05d}", rng.choice([1, 2, 3, None]), rng.choice([0.5, 0.9, None, float("nan"), rng.random()])) for i in range(6000)]
    rows.append((None, "rx", 3, 0.9))
    items = spark.createDataFrame([(*r, "z") for r in rows], "g string, item string, s int, m double, _group string")
    groups = spark.createDataFrame([(g,) for g in ["hot", "hot", "g1", "g2", "g7", "none", None]], "g string")
    got = sorted((r["g"], r["place"], r["item"]) for r in topn.top_n(items, groups, "g", "item", "s", "m", 5).collect())
    assert got == _brute_top(rows, ["hot", "g1", "g2", "g7"], 5)


@pytest.mark.parametrize("fractional", [False, True])
def test_row_groups_of_many_small_groups_are_skipped(spark, monkeypatch, fractional):
    monkeypatch.setattr(topn, "ROW_GROUP_ROWS", (200, 200))
    rng = random.Random(9)
    score = (lambda g: rng.choice([None, g % 7 + rng.random() * 3, float("nan")])) if fractional else (lambda g: rng.choice([None, g % 7 + rng.randint(0, 3), g % 7]))
    rows = [(f"g{i % 150}", f"r{i:05d}", score(i % 150), rng.choice([0.5, None, rng.random(), float("inf"), -float("inf")])) for i in range(9000)]
    items = spark.createDataFrame(rows, f"g string, item string, s {'double' if fractional else 'int'}, m double")
    groups = spark.createDataFrame([(f"g{k}",) for k in range(140)], "g string")
    got = sorted((r["g"], r["place"], r["item"]) for r in topn.top_n(items, groups, "g", "item", "s", "m", 5).collect())
    assert got == _brute_top(rows, [f"g{k}" for k in range(140)], 5)
    figures = topn.skipping(items, groups, "g", "item", "s", "m", 5).first()
    assert figures["row_groups_skipped"] >= 5 and figures["row_groups_read"] >= 5


def test_top_n_of_nothing(spark):
    items = spark.createDataFrame([], "g string, item string, s int, m double")
    groups = spark.createDataFrame([], "g string")
    assert topn.top_n(items, groups, "g", "item", "s", "m", 5).count() == 0


def test_row_groups_below_the_nth_score_are_skipped(spark, tmp_path):
    rows = [("hot", i * 1.0, i * 1.0, 0.0, f"i{i:06d}") for i in range(60_000)]
    df = spark.createDataFrame(rows, "_group string, _bound double, _first double, _second double, _item string").coalesce(1).sortWithinPartitions("_group", topn.F.desc("_bound"))
    df.write.option("parquet.block.size", str(64 * 1024)).parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    best, read, skipped = topn.scan_clustered(f"file://{file}", 5)
    assert list(best["_item"]) == [f"i{59_999 - k:06d}" for k in range(5)]
    assert read == 1 and skipped >= 3


def test_latest_rows_take_only_the_last_recording(spark):
    df = spark.createDataFrame([("r", 1, 1, 9), ("r", 2, 1, 3), ("r", 2, 5, 3), (None, 9, 9, 9), ("q", None, 1, 4)], "k string, at int, then int, v int")
    assert {(r["k"], r["v"]) for r in topn.latest_rows(df, "k", "at", "then", "v").collect()} == {("r", 3), ("q", 4)}


def test_bounds_of_fractions_rise_with_the_order(spark):
    pairs = [(None, 5.0), (-1e300, 0.0), (0.9, 0.99), (1.0, -3.0), (1.0, 0.9), (1.1, 0.0), (1.1, None), (2.0, 0.1)]
    df = spark.createDataFrame(pairs, "a double, b double")
    rows = sorted(df.withColumn("bound", topn.score_bound(F.col("a"), F.col("b"), whole=False)).collect(), key=lambda r: tuple((x is not None, x or 0.0) for x in r[:2]))
    bounds = [r["bound"] for r in rows]
    assert bounds == sorted(bounds)


# --- truncation


def _captions():
    rng = random.Random(1)
    nouns = ["lamp", "chair", "river", "window", "bridge", "market", "garden", "kettle", "ladder", "blanket", "harbor", "station"]
    adjectives = ["wooden", "yellow", "narrow", "broken", "painted", "quiet", "silver", "heavy"]
    one = lambda: f"A {rng.choice(adjectives)} {rng.choice(nouns)} stands behind the {rng.choice(adjectives)} {rng.choice(nouns)}."
    return [" ".join(one() for _ in range(rng.randint(2, 5))) for _ in range(1500)]


def test_cut_texts_are_told_from_whole_ones(spark):
    whole = _captions()
    rng = random.Random(2)
    rows = [("t", i, w if i % 3 else w.rstrip("."), None) for i, w in enumerate(whole)]
    cuts = []
    for i in range(300):
        t = whole[i]
        k = rng.choice([m for m in range(20, len(t)) if t[m - 1].isalpha() and t[m].isalpha() and not t[m - 2].isspace()])
        cuts.append(("t", 10_000 + i, t[:k] + rng.choice(["", "", " ...", " [...]"]), None))
    rows += cuts + [("t", 20_000, None, None), ("t", 20_001, "", None), ("t", 20_002, whole[0] + "...", None), ("t", 20_003, "x" * 300_000, None)]
    df = spark.createDataFrame(rows, "tab string, id int, text string, cut int")
    got = {r["id"] for r in truncation.score_all(df, "tab", "text").filter("cut").select("id").collect()}
    true = {c[1] for c in cuts}
    assert len(got & true) >= 0.9 * len(true)
    assert len(got & set(range(len(whole)))) <= 0.02 * len(whole)
    assert not got & {20_000, 20_001, 20_002}


def test_words_are_counted_beyond_the_sample(spark, monkeypatch):
    """Whole texts that end on a noun which is common in the table, but not in the training sample, are not cut."""
    whole = _captions()
    named = [f"{w} A quiet basket stands behind the heavy basket." for w in whole[:60]]
    df = spark.createDataFrame([("t", i, t) for i, t in enumerate(whole + named)], "tab string, id int, text string")
    fit = truncation.fit
    monkeypatch.setattr(truncation, "fit", lambda sample, *rest: fit(spark.createDataFrame([("t", t) for t in whole[:1000]], "_table string, _text string"), *rest))
    got = {r["id"] for r in truncation.score_all(df, "tab", "text").filter("cut").select("id").collect()}
    assert len(got & set(range(len(whole), len(whole) + 60))) <= 3


def test_words_of_all_texts(spark):
    texts = ["The lamp. A lamp stands by the lamp", "By the lamp stands a lam", "Lamp lamp"]
    df = spark.createDataFrame([("t", t) for t in texts], "tab string, text string")
    got = {r["word"]: tuple(r[1:]) for r in truncation.word_counts(df, "tab", "text", {}).collect()}
    assert got["lamp"] == (4, 6, 3, 2) and got["lam"] == (0, 1, 1, 1) and got["the"] == (3, 3, 0, 0)


def test_truncation_of_nothing(spark):
    df = spark.createDataFrame([], "tab string, text string")
    assert truncation.score_all(df, "tab", "text").count() == 0


def test_every_length_that_stands_out_is_a_limit(spark):
    rng = random.Random(4)
    limits = [15 + 20 * k for k in range(12)]
    rows = [(f"t{k % 130}", "x" * rng.randint(5, 300)) for k in range(2600)] + [("big", "y" * rng.randint(5, 300)) for k in range(3000)]
    rows += [("big", "z" * n) for n in limits for _ in range(90)]
    found = truncation.field_limits(spark.createDataFrame(rows, "tab string, text string"), "text", "tab")
    assert set(limits) <= set(found["big"]) and len(found["big"]) <= 13


def test_long_words_and_marks_at_the_end_are_seen_whole():
    assert truncation.last_word("a " + "b" * 400) == "b" * 400
    assert truncation.tidy("a lamp th" + "." * 900) == ("a lamp th", "dots")
    assert truncation.tidy("a lamp th" + " [...]" * 300) == ("a lamp th", "other")


def test_tidy_takes_marks_off():
    assert truncation.tidy("a row of th [cut]") == ("a row of th", "other")
    assert truncation.tidy("a lamp...") == ("a lamp", "dots")
    assert truncation.tidy("a lamp.") == ("a lamp.", "")
    assert truncation.tidy("the car tools pas &hel")[0] == "the car tools pas"


# --- epoch sample


def test_draws_are_uniform_and_stable(spark):
    keys = spark.range(20_000).selectExpr("cast(id as string) as key", "1 as first_epoch", "0.1D as rate")
    a = {r[0] for r in epoch_sample.chosen(keys, 7).select("key").collect()}
    b = {r[0] for r in epoch_sample.chosen(keys.repartition(13), 7).select("key").collect()}
    assert a == b and abs(len(a) / 20_000 - 0.1) < 0.01


def test_chosen_records_stay_chosen_as_data_and_rates_change(spark):
    rows = lambda lo, hi, e: spark.createDataFrame([(f" IMG{i} " if i % 2 else f"img{i}", e) for i in range(lo, hi)], "image_id string, batch int")
    ledger = epoch_sample.first_seen(rows(0, 3000, 1), "image_id", "batch", {0: 0.2})
    before = {r[0] for r in epoch_sample.chosen(ledger).select("key").collect()}
    later = epoch_sample.advance(ledger, rows(0, 6000, 2), "image_id", "batch", {0: 0.01})
    after = {r[0] for r in epoch_sample.chosen(later).select("key").collect()}
    assert before <= after and len(before) > 400
    assert {r[0] for r in later.filter("first_epoch = 2").select("rate").distinct().collect()} == {0.01}


def test_a_ledger_grows_by_deliveries_and_keeps_its_parts(spark, tmp_path):
    rows = lambda ids: spark.createDataFrame([(f" IMG{i} ", "x") for i in ids] + [(None, "x")], "image_id string, key string")
    path = f"file://{tmp_path}/ledger"
    rates = {0: 0.3}
    one = {tuple(r) for r in epoch_sample.deliver(spark, path, rows(range(800)), "image_id", 1, rates).collect()}
    rates[2] = 0.05  # a later rate, frozen for later deliveries only
    two = {tuple(r) for r in epoch_sample.deliver(spark, path, rows(range(400, 1200)), "image_id", 2, rates).collect()}
    assert one < two and len(two) == 1200 and {r[1:] for r in two - one} == {(2, 0.05)} and {r[1:] for r in one} == {(1, 0.3)}
    again = {tuple(r) for r in epoch_sample.deliver(spark, path, rows(range(400, 1200)), "image_id", 2, rates).collect()}
    assert again == two
    before = {r["key"] for r in epoch_sample.chosen(spark.createDataFrame(sorted(one), epoch_sample.LEDGER)).collect()}
    assert before <= {r["key"] for r in epoch_sample.chosen(epoch_sample.read_ledger(spark, path)).collect()} and len(before) > 150


def test_a_replay_is_the_first_seen_ledger(spark, tmp_path):
    rng = random.Random(12)
    df = spark.createDataFrame([(rng.choice([None, " ", "A", "a "]) if i % 9 == 0 else f"k{rng.randint(0, 60)}", rng.choice([None, 0, 1, 2, 5])) for i in range(400)], "image_id string, batch int")
    rates = {0: 0.5, 2: 0.1}
    replayed = epoch_sample.replay(df, "image_id", "batch", rates, f"file://{tmp_path}/ledger")
    assert sorted(map(tuple, replayed.collect())) == sorted(map(tuple, epoch_sample.first_seen(df, "image_id", "batch", rates).collect()))
    assert epoch_sample.replay(df.limit(0), "image_id", "batch", rates, f"file://{tmp_path}/none").count() == 0


def test_sample_edges(spark):
    df = spark.createDataFrame([(None, 1), ("  ", 1), ("a", None), ("A ", 3), ("a", 3)], "image_id string, batch int")
    ledger = epoch_sample.first_seen(df, "image_id", "batch", {2: 1.0})
    assert [(r["key"], r["first_epoch"], r["rate"]) for r in ledger.collect()] == [("a", 3, 1.0)]
    assert epoch_sample.first_seen(df.limit(0), "image_id", "batch", {0: 0.1}).count() == 0


# --- term counts


def test_term_counts_equal_sets(spark):
    rng = random.Random(4)
    values = ["Car", "car", "ｃａｒ", "c​ar", "car\xa0", " big  car", "big car", None, "", "​", "é", "é"]
    rows = [("f" if i % 2 else "h", rng.choice(values), rng.choice([None, *range(25)])) for i in range(3000)]
    df = spark.createDataFrame([(f, v, str(r) if r is not None else None, "x") for f, v, r in rows], "field string, value string, record string, term string")
    got = {(r["field"], r["term"]): (r["occurrences"], r["records"], r["field_records"]) for r in term_counts.count_terms(df, salts=3).collect()}
    want, whole = {}, {}
    for f, v, r in rows:
        t = term_counts.normal_term(v)
        if t is not None:
            n, s = want.setdefault((f, t), [0, set()])
            want[f, t][0] = n + 1
            if r is not None:
                s.add(r)
                whole.setdefault(f, set()).add(r)
    assert got == {k: (n, len(s), len(whole[k[0]])) for k, (n, s) in want.items()}
    assert term_counts.count_terms(df.limit(0)).count() == 0


def test_marks(spark):
    df = spark.createDataFrame([("f", "a", 9, 2, 100), ("f", "b", 9, 6, 100), ("f", "c", 9, 5, 100), ("f", "d", 9, 3, 40)], "field string, term string, occurrences bigint, records bigint, field_records bigint")
    assert {r["term"]: r["mark"] for r in term_counts.marked(df).collect()} == {"a": "rare", "b": "common", "c": None, "d": "common"}


# --- leakage


def _corpus():
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)] + ["the", "a", "of"] * 60
    passages = [(f"p{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 60)))) for i in range(25)]
    passages += [("same", passages[0][1]), ("zh", "从峤川园望过去高脚水壶挨着汀屿桥条纹雨伞则归苇溪坊所有由峤云巷看管"), ("none", None), ("blank", " ")]
    docs = []
    for i in range(300):
        noise = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        w = passages[rng.randrange(25)][1].split()
        kind = i % 6
        if kind == 0:
            noise[5:5] = w
        elif kind == 1:
            k = rng.randint(6, 14)
            s = rng.randrange(max(1, len(w) - k))
            noise[3:3] = w[s : s + k]
        elif kind == 2:
            noise[2:2] = [x for x in w if rng.random() < 0.85]
        elif kind == 3:
            half = len(w) // 2
            noise = w[:half] + noise + w[half:]
        elif kind == 4:
            noise[0:0] = [x.upper() + "," for x in w[:12]]
        docs.append((i, " ".join(noise)))
    docs += [(900, None), (901, ""), (902, "前文。从峤川园望过去，高脚水壶挨着汀屿桥，条纹雨伞。后文"), (903, "从峤川园望过去，高脚"), (1, "repeated id"), (None, docs[0][1]), (904, "word1 " * 50_000)]
    return docs, passages


def test_leaks_equal_brute_force(spark):
    docs, passages = _corpus()
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, row_no int")
    e = spark.createDataFrame(passages + passages[:3], "item_id string, passage string")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.find_leaks(d, e).collect()}
    assert got == leakage.plain_leaks([x for x in docs if x[1]], [p for p in passages if p[1]])
    assert (902, "zh") in got and (903, "zh") not in got


def test_leaks_in_blocks_are_the_same(spark, monkeypatch):
    docs, passages = _corpus()
    d = spark.createDataFrame(docs[:120], "doc_id bigint, text string")
    e = spark.createDataFrame(passages, "item_id string, passage string")
    whole = {(r["doc_id"], r["item_id"]) for r in leakage.find_leaks(d, e).collect()}
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 2500)
    assert {(r["doc_id"], r["item_id"]) for r in leakage.find_leaks(d, e).collect()} == whole


def test_leaks_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    e = spark.createDataFrame([], "item_id string, passage string")
    one = spark.createDataFrame([("i", "some words here")], "item_id string, passage string")
    assert leakage.find_leaks(d, e).count() == 0 and leakage.find_leaks(d, one).count() == 0


def test_tokens_set_form_aside():
    composed, apart = "caf\u00e9", "cafe\u0301"
    got = [unicodedata.normalize("NFC", w) for w in leakage.tokens(f"Di\xade <b>STRASSE</b>, {composed} &nbsp; ﬁn 图67里")]
    assert got == ["die", "strasse", composed, "fin", "图", "67", "里"]
    assert leakage.tokens(apart) == leakage.tokens(composed) and leakage.tokens("Straße") == leakage.tokens("STRASSE")
    assert leakage.tokens(None) == leakage.tokens(" . ") == []


def test_postings_of_a_batch():
    text = pa.array([None, "b a  b", "", "A c"])
    hashes = leakage.term_hashes(pa.array(["a", "b"]))
    wanted = np.zeros(1 << leakage.FIELD_BITS, bool)
    wanted[leakage.field_places(hashes)] = True
    got = leakage.postings(pa.array([7, 8, 9, 10]), pa.array([1, 2, 3, None], pa.int64()), text, np.packbits(wanted, bitorder="little"))
    names = dict(zip(hashes.tolist(), "ab"))
    rows = {(names[r["term"]], r["row_no"], r["doc_id"], tuple(r["positions"])) for r in got.to_pylist()}
    assert rows == {("a", 8, 2, (1,)), ("b", 8, 2, (0, 2)), ("a", 10, None, (0,))}


def test_batches_are_parted_by_bytes():
    batch = pa.record_batch([pa.array(["x" * 10, None, "y" * 90, "", "z" * 300, "w"])], names=["text"])
    parts = list(leakage.by_bytes(batch, "text", 100))
    assert [x for p in parts for x in p["text"].to_pylist()] == batch["text"].to_pylist() and len(parts) >= 3
    assert list(leakage.by_bytes(batch.slice(0, 0), "text", 100)) == []


# --- mixing


def test_rake_meets_sources_and_caps():
    cells = pd.DataFrame(
        [("a", "en", "x", 100, 1.0, None), ("a", "de", "y", 50, 1.0, None), ("b", "en", "x", 200, 2.0, 1.0), ("b", "de", "x", 40, 2.0, 1.0), ("c", "en", "y", 10, 1.0, 3.0), ("d", None, None, 0, 1.0, 2.0)],
        columns=["source", "lang", "topic", "tokens", "weight", "max_repeats"],
    )
    cells["max_repeats"] = cells["max_repeats"].astype(float)
    out = mixing.rake(cells)
    reached = (out["uses"] * out["tokens"]).groupby(out["source"]).sum()
    assert (out["uses"] <= out["max_repeats"].fillna(math.inf) + 1e-9).all()
    first = out.drop_duplicates("source").set_index("source")
    for s in "abcd":
        assert math.isclose(reached[s], first.loc[s, "reachable"], rel_tol=1e-6, abs_tol=1e-9)
    assert dict(first["short"]) == {"a": False, "b": False, "c": True, "d": True}
    assert math.isclose(first["goal"].sum(), 400)


def test_shares_of_the_registered_mixes_are_near_their_goals(spark, data):
    """Over ten thousand documents every source reaches what it can within 5 % or two longest documents, and in mixes
    without short sources every share is within 0.02 of its goal."""
    from sightline.llm import queries

    sizes, fitted = queries._mix(spark, data.replace("sf0.001", "sf0.1"))
    rows = mixing.report(sizes, fitted).collect()
    longest = sizes.agg(F.max("tokens")).first()[0]
    assert sum(not r["short"] for r in rows) > 10
    for mix in {r["mix_id"] for r in rows}:
        mine = [r for r in rows if r["mix_id"] == mix]
        whole = sum(r["goal"] for r in mine)
        for r in mine:
            if not r["short"]:
                assert abs(r["reached"] - r["goal"]) <= 0.05 * r["goal"] + 2 * longest, r
                assert any(x["short"] for x in mine) or abs(r["share"] - r["goal"] / whole) <= 0.02, r


def test_mixes_end_to_end(spark):
    docs = [(i, " Alpha " if i % 2 else "beta", "en" if i % 3 else "deu", f"some words and number {i}") for i in range(400)]
    docs += [(900, None, None, "x"), (901, "beta", None, None), (902, "gamma", "xx", "  "), (903, "beta", "en", "")]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, text string")
    t = spark.createDataFrame([("m", "ALPHA", 3.0, 2), ("m", "beta", 1.0, None), ("n", "gamma", 1.0, 5), ("n", "alpha", None, 1), ("o", None, 1.0, 1), ("m", "missing", 1.0, 9), ("q", "beta", float("nan"), -1)], "mix_id string, source string, target_share double, max_repeats int")
    sizes = mixing.sized(d)
    fitted = mixing.fit(sizes, t)
    short = {(r["mix_id"], r["source"]) for r in fitted.filter("short").select("mix_id", "source").collect()}
    assert short == {("n", "gamma"), ("m", "missing")}
    report = {(r["mix_id"], r["source"]): r for r in mixing.report(sizes, fitted).collect()}
    assert abs(report["m", "alpha"]["reached"] / report["m", "alpha"]["goal"] - 1) < 0.1
    assert mixing.members(sizes, fitted).filter("mix_id = 'm' and source = 'alpha' and repeats > 2").count() == 0
    again = mixing.members(sizes.repartition(3), fitted).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixing.members(sizes, fitted).collect()))


def test_mixes_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id bigint, source string, lang string, text string")
    t = spark.createDataFrame([("m", "a", 1.0, 2)], "mix_id string, source string, target_share double, max_repeats int")
    sizes = mixing.sized(d)
    assert [r["short"] for r in mixing.fit(sizes, t).collect()] == [True]
    assert mixing.fit(sizes, t.limit(0)).count() == 0


# --- sentences

CASES = [
    ("Dr. A. B. Lee paid 3.50 euros. Then he left!", ["Dr. A. B. Lee paid 3.50 euros.", "Then he left!"]),
    ("It closed at 6 p.m. The gate stayed open. He left at 7 a.m. and ran.", ["It closed at 6 p.m.", "The gate stayed open.", "He left at 7 a.m. and ran."]),
    ('He wrote: "Redraw it. It is cut off." Next came rain.', ['He wrote: "Redraw it. It is cut off."', "Next came rain."]),
    ('"Why only one?" asked Prof. Kim at the desk. \'Mind the gap.\' reads the line.', ['"Why only one?" asked Prof. Kim at the desk.', "'Mind the gap.' reads the line."]),
    ("It fell. (The second was lost.) (So was the third.) The cup (see No. 2; it broke.) is here.", ["It fell.", "(The second was lost.)", "(So was the third.)", "The cup (see No. 2; it broke.) is here."]),
    ("We had two... but lost one. No era el carro... Faltaban sacos, etc.", ["We had two... but lost one.", "No era el carro...", "Faltaban sacos, etc."]),
    ("Title here\n\nFirst line\ngoes on. Second\n\n1. one thing\n2. 17.8 overlap, two\n- three", ["Title here", "First line\ngoes on.", "Second", "1. one thing", "2. 17.8 overlap, two", "- three"]),
    ("Im 2. Durchgang blieb er, d. h. alles. Am 3. Mai z. B. nicht.", ["Im 2. Durchgang blieb er, d. h. alles.", "Am 3. Mai z. B. nicht."]),
    ("审阅者问道：“为什么？”“小心台阶！”刷在墙上。那天很晚了……还在。", ["审阅者问道：“为什么？”", "“小心台阶！”刷在墙上。", "那天很晚了……还在。"]),
    ("文件tile_780.json保存了掩码。Dr. 李不同意；其他人同意。", ["文件tile_780.json保存了掩码。", "Dr. 李不同意；其他人同意。"]),
    ("มีกล่องไม้ในภาพ ค่าเท่ากับ 3.5 ซึ่งสูงพอ ใครย้าย", ["มีกล่องไม้ในภาพ", "ค่าเท่ากับ 3.5 ซึ่งสูงพอ", "ใครย้าย"]),
    ("डॉ. नील ने देखा। पृ. 4 पर है। रुकिए!", ["डॉ. नील ने देखा।", "पृ. 4 पर है।", "रुकिए!"]),
    ("هل رأيت؟ سأل أ. د. سوق. قف!", ["هل رأيت؟", "سأل أ. د. سوق.", "قف!"]),
    ("В 2019 г. Петров жил на ул. Мира, д. 5. Там были доски и т. д. до вечера.", ["В 2019 г. Петров жил на ул. Мира, д. 5.", "Там были доски и т. д. до вечера."]),
    ("One ended.Two began!three went on", ["One ended.", "Two began!", "three went on"]),
    ("See https://a.example/x.y?z=1 now. Mail a.b@c.org today.", ["See https://a.example/x.y?z=1 now.", "Mail a.b@c.org today."]),
]


CASES += [
    ("See https://a.example/" + "x" * 1500 + ".html?q=1 now. Then" + " " * 40 + "rest.", ["See https://a.example/" + "x" * 1500 + ".html?q=1 now.", "Then" + " " * 40 + "rest."]),
    ("Am" + " " * 30 + "3. Mai war es so" + "." * 30 + " aber gut.\n" + " " * 20 + "1. ein Ding", ["Am" + " " * 30 + "3. Mai war es so" + "." * 30 + " aber gut.", "1. ein Ding"]),
    ("看" + "…" * 25 + "还在。", ["看" + "…" * 25 + "还在。"]),
    ('He fell. ((")"))' + '"' * 12 + "        (It was late.) Then up.", None),
]


@pytest.mark.parametrize("text,want", CASES)
def test_sentences(spark, text, want):
    df = spark.createDataFrame([(1, text, "u")], "doc_id int, text string, _units string")
    rows = sentences.split_sentences(df, "doc_id", "text", restore=True).orderBy("place").collect()
    assert want is None or [r["sentence"] for r in rows] == want
    assert all(text[r["start_at"] : r["end_at"]] == r["sentence"] for r in rows)


def test_sentence_offsets_cover_everything(spark):
    rng = random.Random(6)
    pieces = ["Word", "a", " ", "  ", "\n", "\n\n", ".", "...", "!", "?", '"', "'", "(", ")", "“", "”", "«", "»", "。", "3.5", "Dr.", ":", "😀", "​", "ก", " ข", "- ", "1. ", "\r\n", "", "", "[", "]"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", " \n "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = sentences.split_sentences(df, "doc_id", "text", restore=True).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start_at"])):
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        at = 0
        for r in by.get(i, []):
            assert r["start_at"] >= at and t[at : r["start_at"]].strip() == ""
            unit = t[r["start_at"] : r["end_at"]]
            assert unit == unit.strip() == r["sentence"] != ""
            at = r["end_at"]
        assert (t or "")[at:].strip() == ""


def test_sentences_of_long_and_no_text(spark):
    long = "One two three. " * 5000
    df = spark.createDataFrame([(1, long), (1, "Twice. Here."), (2, "x" * 200_000)], "doc_id int, text string")
    assert sentences.split_sentences(df, "doc_id", "text").count() == 5003
    assert sentences.split_sentences(df.limit(0), "doc_id", "text").count() == 0


# --- the registered queries


def test_registered_queries_run(spark, data):
    from sightline.llm import queries

    for name, query in queries.queries().items():
        assert query(spark, data).columns, name
    assert set(queries.oracle_sql()) <= set(queries.queries())
