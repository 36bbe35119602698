"""Golden values, and operators against plain Python."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sightline.functions import geometry as G
from sightline.functions import text as T
from sightline.operators import consensus, folds, relational, spatial
from sightline.operators.components import components, keyed_components
from sightline.sources import files


def _boxes(spark, rows):
    return spark.createDataFrame(rows, "k int, i int, x1 double, y1 double, x2 double, y2 double")


def _random_boxes(n, keys, seed, span=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randint(0, span), rng.randint(0, span)
        out.append((rng.randrange(keys), i, float(x), float(y), float(x + rng.randint(1, 30)), float(y + rng.randint(1, 30))))
    return out


def _iou(a, b):
    w = max(0.0, min(a[4], b[4]) - max(a[2], b[2])) * max(0.0, min(a[5], b[5]) - max(a[3], b[3]))
    u = (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - w
    return w / u if u > 0 else 0.0


# --- geometry


def test_crop_mapping_and_size_gate(spark):
    lit = lambda *v: G.Box(*[F.lit(float(x)) for x in v])
    crop = G.crop_to_original(lit(0, 0, 50, 100), lit(100, 200, 200, 400), F.lit(100.0), F.lit(200.0))
    assert list(spark.range(1).select(*crop).first()) == [100.0, 200.0, 150.0, 300.0]
    w = F.lit(1000)
    reason = lambda *v: spark.range(1).select(G.size_columns(lit(*v), w, w)["size_reject_reason"]).first()[0]
    assert reason(0, 0, 1, 1) == "bbox_area_below_0_001_percent"
    assert reason(0, 0, 800, 800) == "bbox_area_above_10_percent"
    assert reason(0, 0, 1, 100) is None


def test_iou_is_symmetric_and_bounded(spark):
    df = _boxes(spark, _random_boxes(60, 1, 1))
    a, b = df.alias("a"), df.alias("b")
    r = a.crossJoin(b).select(G.iou(G.box("a."), G.box("b.")).alias("p"), G.iou(G.box("b."), G.box("a.")).alias("q"))
    assert r.filter("p <> q or p < 0 or p > 1").count() == 0


def test_regions(spark):
    lit = lambda *v: G.Box(*[F.lit(float(x)) if x is not None else F.lit(None).cast("double") for x in v])
    px = lambda *v: list(spark.range(1).select(*G.region_to_pixels(lit(*v), F.lit(200), F.lit(100))).first())
    assert px(100, 100, 500, 500) == [20.0, 10.0, 100.0, 50.0]
    assert px(500, 100, 100, 500) == px(0, 0, 1001, 5) == px(None, 0, 5, 5) == px(float("nan"), 0, 5, 5) == [None] * 4
    with pytest.raises(Exception, match="invalid normalized region"):
        spark.range(1).select(*G.checked_region(lit(9, 9, 1, 1), F.lit(10), F.lit(10))).collect()


# --- text


BOX_ANSWERS = [
    ('<think>[0,0,10,10]</think>{"bbox_2d":[100,200,300,400]}', [20.0, 20.0, 60.0, 40.0]),
    *[(x, None) for x in ("no box", "[1,2,3,4] [20,30,40,50]", "[-1,2,3,4]", "[1,2,NaN,4]", "<think>[1,2,3,4]", "[5,5,1,1]", "[1,2,3", "", None, "[true,0,1,2]", "[]", "{}", "[[]]")],
    ("<think>a</think><think>[1,2,3,4]", None),
    ("[1,2,3,4] and [2000,2,3,4]", None),
    ('{"bbox_2d":[100,200,300,400,5],"x":[100,200,300,400]}', None),
    ('{"bbox_2d":"none"} [100,200,300,400]', None),
    ('{"box":[1,2,3,4],"bbox_2d":[100,200,300,400]}', [20.0, 20.0, 60.0, 40.0]),
    ('[{"a":{"b":[[100,200,300,400]]}}] {broken [100,200,300,400]', [20.0, 20.0, 60.0, 40.0]),
    ("[100,200,300,400] [100.0,200,3e2,400]", [20.0, 20.0, 60.0, 40.0]),
    ("[" * 300 + "100,200,300,400" + "]" * 300, [20.0, 20.0, 60.0, 40.0]),
    ("[1" + "0" * 400 + ",2,3,4]", None),
]


def test_boxes_in_answers(spark):
    df = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(BOX_ANSWERS)], "k int, a string").repartition(2)
    got = {r["k"]: r["b"] for r in df.select("k", T.parsed_box(F.col("a"), F.lit(200), F.lit(100)).alias("b")).collect()}
    assert [got[k] for k in range(len(BOX_ANSWERS))] == [w for _, w in BOX_ANSWERS]


def test_text_forms(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "v string").select(c(F.col("v"))).first()[0]
    assert one(T.safe_id, " é/a b__") == "a_b" and one(T.safe_id, "//") == "entity" and one(T.safe_id, None) == "entity"
    assert one(T.collapse, " a \n b ") == "a b" and one(T.collapse, "  ") is None
    assert one(T.url_stem, "https://h/x/sa_1.jpg?y=2.z") == "sa_1" and one(T.url_stem, "a/b.png") == "b"
    assert one(T.json_object_text, 'x ```json\n{"a": 1}\n``` y') == '{"a": 1}' and one(T.json_object_text, "none") is None
    k = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a", "")], "p string, q string")
    assert k.select(T.content_key(F.col("p"), F.col("q"))).distinct().count() == 4


# --- folds, components, joins


def _greedy(rows, t):
    winner = {}
    for k in {r[0] for r in rows}:
        kept = []
        for r in sorted([r for r in rows if r[0] == k], key=lambda r: r[1]):
            hit = next((o for o in kept if _iou(o, r) >= t), None)
            winner[r[1]] = hit[1] if hit else None
            if hit is None:
                kept.append(r)
    return winner


@pytest.mark.parametrize("limit", [1000, 0])
def test_folds_and_rounds_equal_plain_greedy(spark, limit):
    rows = _random_boxes(160, 3, 2)
    df = _boxes(spark, [(k if k else None, *r) for k, *r in rows])
    got = {r["i"]: r["winner"] for r in folds.greedy(df, ["k"], "i", 0.3, fold_rows=limit).collect()}
    assert got == _greedy(rows, 0.3)


@pytest.mark.parametrize("limit", [1000, 0])
def test_equal_values_are_alike_too(spark, limit):
    rng = random.Random(8)
    rows = [(*r, rng.choice(["a", "b", None, f"w{r[1]}"])) for r in _random_boxes(120, 2, 4)]
    df = spark.createDataFrame(rows, "k int, i int, x1 double, y1 double, x2 double, y2 double, word string")
    kept, want = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        hit = next((o for o in kept.setdefault(r[0], []) if _iou(o, r) >= 0.3 or (o[6] is not None and o[6] == r[6])), None)
        want[r[1]] = hit[1] if hit else None
        if hit is None:
            kept[r[0]].append(r)
    assert {r["i"]: r["winner"] for r in folds.greedy(df, ["k"], "i", 0.3, ("word",), fold_rows=limit).collect()} == want


def test_a_very_large_group_is_thinned_through_the_grid(spark):
    rng = random.Random(11)
    spots = [(rng.uniform(0, 9000), rng.uniform(0, 9000)) for _ in range(10_000)]
    rows = [(1, 5 * k + j, x + j, y, x + j + 40, y + 40) for k, (x, y) in enumerate(spots) for j in range(5)]
    df = _boxes(spark, rows)
    kept = folds.suppress(df, ["k"], "i", 0.8)
    cells, want = {}, set()
    for r in rows:
        cell = (int(r[2] // 50), int(r[3] // 50))
        near = [o for dx in (-1, 0, 1) for dy in (-1, 0, 1) for o in cells.get((cell[0] + dx, cell[1] + dy), ())]
        if not any(_iou(o, r) >= 0.8 for o in near):
            cells.setdefault(cell, []).append(r)
            want.add(r[1])
    assert {r["i"] for r in kept.select("i").collect()} == want


def test_suppression_is_idempotent_and_not_transitive(spark):
    df = _boxes(spark, [(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 3.0, 0.0, 13.0, 10.0), (1, 3, 6.0, 0.0, 16.0, 10.0)])
    once = folds.suppress(df, ["k"], "i", 0.5)
    assert sorted(r["i"] for r in once.collect()) == [1, 3]
    assert folds.suppress(once, ["k"], "i", 0.5).count() == 2


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7), (None, 3)]
    parent = {}
    find = lambda v: v if parent.setdefault(v, v) == v else find(parent[v])
    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {v: find(v) for v in parent}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_keyed_components_equal_plain_ones(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(30), rng.randrange(12), rng.randrange(12)) for _ in range(200)]
    df = spark.createDataFrame(edges, "k int, a int, b int")
    plain = components(df.selectExpr("k * 100 + a as a", "k * 100 + b as b"))
    want = {(r["node"] // 100, r["node"] % 100): r["component"] % 100 for r in plain.collect()}
    for limit in (1000, 6, 0):
        got = {(r["k"], r["node"]): r["component"] for r in keyed_components(df, ["k"], limit).collect()}
        assert got == want, limit


@pytest.mark.parametrize("cell", [7.0, 256.0])
def test_grid_pairs_equal_all_pairs(spark, cell):
    rows = _random_boxes(120, 2, 4)
    df = _boxes(spark, rows)
    cond = (F.col("a.i") < F.col("b.i")) & (G.iou(G.box("a."), G.box("b.")) >= 0.2)
    got = sorted((r[0], r[1]) for r in spatial.overlapping_pairs(df, df, ["k"], cond, cell).select("a.i", "b.i").collect())
    assert got == sorted((a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and _iou(a, b) >= 0.2)


def test_two_instances_on_which_three_detectors_agree(spark):
    rows = []
    for n, (x1, y1, x2, y2) in enumerate([(100, 100, 300, 400), (600, 120, 780, 410)]):
        for k, g in enumerate(("sam31", "rex_omni", "groundingdino")):
            rows.append((1, 3 * n + k, g, "category", float(x1 + k - 1), float(y1 + k - 1), float(x2 + k - 1), float(y2 + k - 1), 0.9))
    rows.append((1, 6, "sam31", "category", 101.0, 101.0, 301.0, 401.0, 0.5))
    det = spark.createDataFrame(rows, "image_id int, det_no int, grounder string, query_type string, x1 double, y1 double, x2 double, y2 double, score double")
    images = spark.createDataFrame([(1, 1000, 1000)], "image_id int, width int, height int")
    found = consensus.instances(det, images, ["image_id"], "det_no").orderBy("instance_no").collect()
    assert [(r["instance_no"], r["support"], r["size_pass"]) for r in found] == [(1, 3, True), (2, 3, True)]
    target = spark.createDataFrame([(1, 100.0, 100.0, 300.0, 400.0)], "image_id int, x1 double, y1 double, x2 double, y2 double")
    clusters = spark.createDataFrame([(1, r["x1"], r["y1"], r["x2"], r["y2"], r["support"], r["median_iou"]) for r in found], "image_id int, x1 double, y1 double, x2 double, y2 double, support bigint, median_iou double")
    both = consensus.regrounding_audit(target, clusters, ["image_id"]).first()
    assert both["reason"] == "expression_has_multiple_consensus_targets" and not both["passed"]
    assert consensus.regrounding_audit(target, clusters.filter("x1 < 500"), ["image_id"]).first()["passed"]
    assert consensus.instances(det.limit(0), images, ["image_id"], "det_no").count() == 0


def test_tight_mask_boxes_go_first(spark):
    rows = [(1, 0, "sam31", 0.9, 0.0, 0.0, 10.0, 10.0, 1.0, 1.0, 10.0, 10.0, 0), (1, 1, "rex_omni", None, 0.0, 0.0, 10.0, 10.0, None, None, None, None, 0)]
    m = spark.createDataFrame(rows, "image_id int, det_no int, grounder string, score double, x1 double, y1 double, x2 double, y2 double, tx1 double, ty1 double, tx2 double, ty2 double, cluster int")
    r = consensus.representatives(m, ["image_id"], "det_no").first()
    assert (r["x1"], r["method"]) == (1.0, "mask_tight")


# --- relational


def test_spread_numbering_equals_a_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    order = [F.col("v"), F.col("i")]
    want = {r["i"]: r["place"] for r in relational.numbered(df, ["k"], order).collect()}
    assert {r["i"]: r["place"] for r in relational.numbered_spread(df, ["k"], order).collect()} == want


def test_first_seen_wins_among_equal_revisions(spark):
    df = spark.createDataFrame([("b", 1, 1), ("b", 1, 2), ("b", 0, 0), ("c", None, 1)], "k string, revision int, n int")
    got = {(r["k"], r["n"]) for r in relational.latest_per_key(df, ["k"], "revision", [F.col("n")]).collect()}
    assert got == {("b", 1), ("c", 1)}


def test_cap_without_limit_keeps_all(spark):
    df = spark.createDataFrame([(1, i) for i in range(9)], "k int, i int")
    assert relational.capped(df, ["k"], [F.col("i")], None).filter("kept").count() == 9
    assert relational.capped(df, ["k"], [F.col("i")], 2).filter("not kept and reject_reason = 'per_source_cap'").count() == 7


def test_bags_and_partitions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i int, s string")
    assert sorted(map(tuple, relational.bag_difference(a, b).collect())) == [(1, "x", 1, 0), (3, "y", 0, 1)]
    assert relational.bag_difference(a, a).count() == 0
    whole = spark.createDataFrame([(i,) for i in range(4)], "i int")
    faults = relational.partition_faults(whole, [whole.filter("i < 2"), whole.filter("i = 1 or i = 3")], ["i"])
    assert sorted(map(tuple, faults.collect())) == [(1, 1, 2), (2, 1, 0)]


def test_changes_and_signatures(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, s string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "i int, s string")
    assert sorted(map(tuple, relational.changes(old, new, ["i"], "s").collect())) == [(1, "removed"), (2, "changed"), (4, "added")]
    reused, stale = relational.unchanged_and_stale(new.withColumnRenamed("s", "signature"), old.withColumnRenamed("s", "signature").filter("signature is not null"), ["i"])
    assert reused.count() == 0 and stale.count() == 3


def test_candidate_roles_and_json_config(spark, tmp_path):
    from sightline.sources import files

    df = spark.createDataFrame([(1, 2)], "Image int, w int")
    assert files.column_roles(df, {"image": ["img", "image"], "width": ["width"]}) == {"image": "Image", "width": None}
    (tmp_path / "a.json").write_text(json.dumps({"a": {"x": 1, "y": 2}, "b": 3}))
    (tmp_path / "b.json").write_text(json.dumps({"a": {"y": 5}}))
    assert files.merged_config(str(tmp_path / "a.json"), str(tmp_path / "b.json")) == {"a": {"x": 1, "y": 5}, "b": 3}
    with pytest.raises(FileNotFoundError):
        files.merged_config(str(tmp_path / "none.json"))


def test_record_lines(spark, tmp_path):
    from sightline.sources import files

    good = tmp_path / "good.jsonl"
    good.write_text('{"a": 1, "b": "x"}\n\n  \n{"a": 2, "b": null}\n')
    assert sorted(tuple(r) for r in files.read_records(spark, str(good), "a int, b string").collect()) == [(1, "x"), (2, None)]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"a": 1}\n[1, 2]\n')
    with pytest.raises(Exception, match="not a JSON object in bad.jsonl"):
        files.read_records(spark, str(bad), "a int").collect()


def test_annotations(spark, tmp_path):
    from sightline.sources import files

    rows = [{"url": f"https://h/p/sa_{i}.jpg", "file_name": f"sa_{i}.jpg", "caption": "c" if i else " "} for i in range(4)]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert files.read_annotations(spark, [str(tmp_path / "a.jsonl")]).count() == 3
    (tmp_path / "b.jsonl").write_text(json.dumps(rows[1]))
    with pytest.raises(Exception, match="annotated twice"):
        files.read_annotations(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]).collect()
    (tmp_path / "c.jsonl").write_text(json.dumps(rows[2] | {"file_name": "other.jpg"}))
    with pytest.raises(Exception, match="file names disagree"):
        files.read_annotations(spark, [str(tmp_path / "c.jsonl")]).collect()


def test_failures_provenance_and_ids(spark, tmp_path):
    from sightline.sources import files, sinks

    path = str(tmp_path / "failures")
    df = spark.createDataFrame([("i", "ground")], "image_id string, stage string")
    sinks.append_failures(df, path)
    sinks.append_failures(df, path)
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(path).columns == ["image_id", "stage", "error_class", "message", "at"]
    p = sinks.provenance(spark, {"b": 1, "a": 2}, model="m").first()
    assert p["model"] == "m" and len(p["config_sha256"]) == 64
    (tmp_path / "ids.txt").write_text("b\na\n")
    assert sorted(map(tuple, files.id_list(spark, str(tmp_path / "ids.txt")).collect())) == [("a", 1), ("b", 0)]


def test_seeded_sample_is_the_shuffle(spark):
    from sightline.sources import files

    df = spark.createDataFrame([(i,) for i in range(50)], "k int")
    want = list(range(50))
    random.Random(42).shuffle(want)
    got = sorted((r["ordinal"], r["k"]) for r in files.seeded_sample(df, "k", 5, 9, 42).collect())
    assert got == list(enumerate(want))[5:9]
    with pytest.raises(ValueError, match="repeated"):
        files.seeded_sample(df.union(df), "k", 0, 1, 1)


def test_seeded_sample_of_more_keys_than_the_driver_should_hold(spark):
    from sightline.sources import files

    n = 5_000_001
    want = list(range(n))
    random.Random(42).shuffle(want)
    df = spark.range(n).select(F.col("id").alias("k"))
    got = sorted((r["ordinal"], r["k"]) for r in files.seeded_sample(df, "k", 3, 40, 42).collect())
    assert got == list(enumerate(want))[3:40]


def test_seeded_sample_in_blocks_and_pieces(spark, monkeypatch):
    from sightline.sources import files

    names = [None, *sorted(f"n{i}" for i in range(299))]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(names)], "v int, k string")
    want = list(range(300))
    random.Random(7).shuffle(want)
    for block, slots in ((1, 0), (64, 15), (1000, 63)):
        monkeypatch.setattr(files, "_BLOCK", block)
        monkeypatch.setattr(files, "_SLOTS", slots)
        for places in (range(300), range(7), range(90, 200), range(299, 300), range(0)):
            assert files.shuffled(300, 7, places).tolist() == want[places.start : places.stop]
    monkeypatch.setattr(files, "_BLOCK", 64)
    whole = files.seeded_sample(df, "k", 0, 1000, 7)
    assert whole.columns == ["k", "v", "ordinal"] and dict(whole.dtypes)["ordinal"] == "int"
    assert sorted((r["ordinal"], r["k"], r["v"]) for r in whole.collect()) == [(o, names[i], i) for o, i in enumerate(want)]
    assert files.seeded_sample(df, "k", 300, 400, 7).count() == 0 and files.seeded_sample(df.limit(0), "k", 0, 5, 7).count() == 0


def test_every_file_is_hashed_in_pieces(spark, tmp_path):
    import hashlib

    (tmp_path / "a" / "b c").mkdir(parents=True)
    bodies = {"x.bin": b"", "a/__init__.py": b"1", "a/z.gz": b"not packed", "a/x.bin": bytes(range(256)) * 40, "a/b c/y z.bin": b"one"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    df = files.file_hashes(spark, str(tmp_path), chunk=1000)
    assert {r["file"]: r["sha256"] for r in df.collect()} == {k: hashlib.sha256(v).hexdigest() for k, v in bodies.items()}
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()  # no file is held as one cell
    assert [r["file"] for r in files.file_hashes(spark, str(tmp_path / "a" / "x.bin")).collect()] == ["x.bin"]


def test_the_query_hashes_every_table(spark, data):
    import os

    from sightline.plans import files_and_streams

    assert {r["file"] for r in files_and_streams.file_hashes(spark, data).collect()} == set(os.listdir(data))


def test_each_target_of_a_key_is_audited_and_repaired(spark):
    targets = spark.createDataFrame([(1, "a", 1, 0.0, 0.0, 10.0, 10.0), (1, "a", 2, 50.0, 50.0, 60.0, 60.0)], "image_id int, category string, t int, x1 double, y1 double, x2 double, y2 double")
    found = spark.createDataFrame([(1, "a", 0.0, 0.0, 10.0, 10.0, 2, 0.9)], "image_id int, category string, x1 double, y1 double, x2 double, y2 double, support int, median_iou double")
    got = {r["t"]: (r["passed"], r["target_count"]) for r in consensus.regrounding_audit(targets, found, ["image_id", "category"], target="t").collect()}
    assert got == {1: (True, 1), 2: (False, 0)}
    members = spark.createDataFrame(
        [(1, "a", n, g, x, x, x + 6.0, x + 6.0) for n, g, x in ((1, "p", 1.0), (2, "q", 1.1), (3, "p", 52.0), (4, "q", 52.1))],
        "image_id int, category string, n int, grounder string, x1 double, y1 double, x2 double, y2 double",
    )
    sized = targets.withColumn("width", F.lit(100)).withColumn("height", F.lit(100))
    options = consensus.repair_options(members, sized, ["image_id", "category"], "n", target="t").collect()
    assert sorted((r["t"], r["n"], r["place"]) for r in options) == [(1, 1, 1), (1, 2, 2), (2, 3, 1), (2, 4, 2)]


def test_context_views_without_full_image_and_repeats(spark):
    rows = [(k, n, *b, 100.0, 100.0, k == 2) for k in (1, 2) for n, b in enumerate([(0.0, 0.0, 100.0, 100.0), (0.0, 0.0, 50.0, 50.0), (0.0, 0.0, 50.0, 50.5), (0.0, 0.0, 40.0, 50.0), (60.0, 0.0, 90.0, 50.0), (0.0, 60.0, 9.0, 70.0)])]
    df = spark.createDataFrame(rows, "k int, n int, x1 double, y1 double, x2 double, y2 double, width double, height double, b boolean")
    got = folds.context_views(df, ["k"], "n", F.col("b")).collect()
    assert sorted((r["k"], r["n"], r["place"]) for r in got) == [(1, 1, 1), (1, 3, 2), (1, 4, 3), (2, 1, 1), (2, 3, 2)]


def test_answers_are_the_expected_ones_once(spark):
    ids = lambda rows: spark.createDataFrame(rows, "k int, peer int")
    expected = ids([(k, p) for k in (1, 2, 3, 4) for p in (1, 2)])
    returned = ids([(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (3, 2), (4, 1), (4, 2), (4, 9)])
    got = {r["k"]: tuple(r[1:]) for r in relational.answer_faults(expected, returned, ["k"], "peer").collect()}
    assert got == {1: (0, 0, 0, True), 2: (1, 0, 0, False), 3: (0, 0, 1, False), 4: (0, 1, 0, False)}
    seen = spark.createDataFrame([(1, 1, True), (1, 2, False), (1, 3, None)], "k int, peer int, also_matches boolean")
    assert sorted(map(tuple, relational.conflict_ids(seen, ids([(1, 1), (1, 7)]), ["k"], "peer").collect())) == [(1, 1), (1, 7)]


# --- streams


def test_streams_over_batches_late_rows_and_a_restart(spark, tmp_path):
    from datetime import datetime

    from sightline.streaming import replay

    schema = "request_id bigint, image_id bigint, stage string, ts timestamp, committed boolean"
    at = lambda h, m: datetime(2025, 1, 1, h, m)

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log.parquet"))

    def log():
        return replay.read_log(spark, str(tmp_path), "log", spark.createDataFrame([], schema).schema, files_per_batch=1)

    def results():
        windows = replay.drain(replay.windowed_counts(log(), "ts", "stage", "1 hour", "10 minutes"), "w", ["window_start", "stage"], f"file://{tmp_path}/w")
        once = replay.drain(replay.once_per_key(log(), ["request_id"], "ts", "10 minutes"), "o", folder=f"file://{tmp_path}/o")
        states = replay.drain(replay.progress_states(log()), "s", ["image_id"], f"file://{tmp_path}/s")
        return (
            {(r["window_start"].hour, r["stage"]): r["rows"] for r in windows.collect()},
            sorted(r["request_id"] for r in once.collect()),
            {r["image_id"]: (r["step"], r["committed"], r["last_request"]) for r in states.collect()},
        )

    add((1, 7, "a", at(10, 0), True), (2, 7, "a", at(10, 30), False))
    add((3, 8, "a", at(12, 30), True), (3, 8, "a", at(12, 30), True))
    add((4, 9, "b", at(12, 31), True))
    windows, once, states = results()
    assert windows == {(10, "a"): 2, (12, "a"): 2, (12, "b"): 1} and once == [1, 2, 3, 4]
    assert states == {7: (2, 1, 2), 8: (2, 2, 3), 9: (1, 1, 4)}
    add((5, 7, "a", at(10, 5), True), (6, 8, "a", at(12, 40), True), (3, 8, "a", at(12, 30), True))  # the first comes too late
    windows, once, states = results()
    assert windows == {(10, "a"): 2, (12, "a"): 4, (12, "b"): 1} and once == [1, 2, 3, 4, 6]
    assert states == {7: (3, 2, 5), 8: (4, 4, 6), 9: (1, 1, 4)}
    assert results() == (windows, once, states)


# --- deliveries, reconciliation, coverage


def test_coverage_of_the_golden_case(spark):
    rows = [("s", False, 0, True)] * 6 + [("s", None, 1, True)] * 4 + [("s", True, 3, False)] + [("bad", True, None, None)]
    got = {r["k"]: r.asDict() for r in relational.coverage(spark.createDataFrame(rows, "k string, invalid boolean, found int, rechecked boolean"), ["k"]).collect()}
    s, bad = got["s"], got["bad"]
    assert (s["total"], s["valid"], s["invalid"], s["empty"], s["rechecked"], s["recovered"], s["distribution"], s["warning"]) == (11, 10, 1, 6, 10, 4, "0:6,1:4", True)
    assert (bad["valid"], bad["empty"], bad["empty_share"], bad["distribution"], bad["warning"]) == (0, 0, None, "", False)


def test_reconciling_takes_whole_known_answers_only(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    requests = df([(1, "p", "h"), (2, "q", "h"), (3, "r", None), (4, "s", "h"), (5, "t", "h"), (6, "p", "h")], "request_id int, phrase string, sha string")
    prior = df([(11, "p", "h"), (12, "q", "h"), (13, "r", None), (14, "s", "h"), (15, "t", "h")], "request_id int, phrase string, sha string")
    progress = df([(11, 2, "now"), (12, 1, "now"), (13, 1, "now"), (14, 0, "now"), (15, 1, "old"), (11, 2, "now")], "request_id int, detections int, context string")
    rows = df([(11, 0, 0.5), (11, 1, 0.6), (12, 0, 0.1), (12, 1, 0.1), (13, 0, 0.1), (15, 0, 0.1)], "request_id int, detection_index int, score double")
    got = relational.reconciled(requests, prior, progress, rows, ["phrase", "sha"], "now").collect()
    assert sorted(((r["request_id"], r["detection_index"]) for r in got), key=str) == [(1, 0), (1, 1), (4, None), (6, 0), (6, 1)]


def test_a_drain_stops_at_its_rounds(spark):
    state = spark.createDataFrame([(1, 0, 0), (2, 2, 0), (3, 9, 0), (4, None, 0)], "id int, needed int, n int")
    done = relational.drained(state, F.col("n") < F.col("needed"), lambda d: d.withColumn("n", F.col("n") + 1), max_rounds=3)
    assert sorted((r["id"], r["n"]) for r in done.collect()) == [(1, 0), (2, 2), (3, 4), (4, 0)]


def test_over_long_requests_are_not_asked_again(spark):
    from sightline.operators import inference

    def model(batch):
        return [inference.OverContext("long") if v == 1 else inference.InvalidAnswer("bad") if v == 2 else {"boxes": [{"x1": -5.0, "y1": 0.0, "x2": 5.0, "y2": 5.0, "score": None}, {"x1": 90.0, "y1": 0.0, "x2": 99.0, "y2": 5.0, "score": 1.0}]} for v in batch["v"]]

    df = spark.createDataFrame([(k, v, 50, 50) for k, v in enumerate([0, 1, 2])] + [(0, 0, 50, 50)], "request_id int, v int, width int, height int")
    found, markers = inference.ground(df, ["v"], model)
    assert [tuple(r) for r in found.collect()] == [(0, 0, 0.0, 0.0, 5.0, 5.0, None)]
    assert sorted(tuple(r) for r in markers.collect()) == [(0, 1, 1, None), (1, 0, 1, "long"), (2, 0, 3, "bad")]


def test_summaries_prefer_a_matching_tight_box(spark):
    rows = [(1, 1, 1, "sam31", 0.9, 0.0, 0.0, 10.0, 10.0, 1.0, 1.0, 9.0, 9.0), (1, 1, 2, "x", 0.5, 1.0, 1.0, 9.0, 9.0, None, None, None, None), (1, 1, 3, "y", None, 0.0, 0.0, 10.0, 9.0, None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, cluster int, i int, grounder string, score double, x1 double, y1 double, x2 double, y2 double, tx1 double, ty1 double, tx2 double, ty2 double")
    r = consensus.summaries(df, ["k"], "i").first()
    assert (r["support"], r["members"], r["x1"], r["x2"], r["method"], r["detectors"]) == (3, 3, 1.0, 9.0, "mask_tight", ["sam31", "x", "y"])
    assert math.isclose(r["mean_score"], 0.7) and r["matched_pairs"] == 3


@pytest.mark.parametrize("spread", [1.0, 4000.0])
def test_nearest_rows_equal_brute_force(spark, spread):
    rng = random.Random(21)
    points = [(k, i, rng.choice([5.0, rng.gauss(0, 1) * spread, rng.uniform(0, 90)]), rng.uniform(0, 90)) for i in range(90) for k in (1, 2, 3) if k < 3 or i < 3]
    points += [(4, 1, 0.0, 0.0), (5, 1, 2.0, 2.0), (5, 2, 2.0, 2.0)]
    df = spark.createDataFrame([(k, i, x, y, x + 2, y + 2, 100, 50) for k, i, x, y in points] + [(1, 999, None, 0.0, 1.0, 1.0, 100, 50)], "k int, i int, x1 double, y1 double, x2 double, y2 double, width int, height int")
    got = {}
    for r in spatial.nearest(df, "k", "i", 4).collect():
        got.setdefault((r["k"], r["i"]), set()).add(r["other"])
    for k, i, x, y in points:
        others = sorted((((u - x) / 100) ** 2 + ((v - y) / 50) ** 2, j) for g, j, u, v in points if g == k and j != i)
        kth = others[: 4][-1][0] if others else 0
        sure = {j for d, j in others[:4] if d < kth * (1 - 1e-9)}
        mine = got.get((k, i), set())
        assert len(mine) == min(4, len(others)) and sure <= mine <= {j for d, j in others if d <= kth * (1 + 1e-9)}, (k, i)


def test_peer_classes_are_told_by_size(spark):
    df = spark.createDataFrame([(1, 1, "a", ["x", "y"]), (1, 2, "a", ["y", "y"]), (1, 3, None, None), (2, 1, "a", [""])], "k int, i int, category string, words array<string>")
    got = {tuple(r) for r in spatial.peer_classes(df, "k", "i", {"category": F.array("category"), "word": F.col("words")}).collect()}
    assert got == {(1, 1, "category", "a", 1), (1, 2, "category", "a", 1), (1, 1, "word", "x", 0), (1, 1, "word", "y", 1), (1, 2, "word", "y", 1), (2, 1, "category", "a", 0)}


def test_altered_snapshots_are_told(spark, tmp_path):
    from sightline.sources import sinks

    df = lambda rows: spark.createDataFrame(rows, "k int, s string")
    path = f"file://{tmp_path}/snap"
    one, two = df([(1, "a"), (2, "b")]), df([(1, "a"), (3, "c")])
    sinks.commit_snapshot(spark, one, None, ["k"], "s", path, 1)
    assert sinks.commit_snapshot(spark, two, one, ["k"], "s", path, 2) == {"added": 1, "removed": 1}
    assert sorted((r["k"], r["s"]) for r in sinks.restore_snapshot(spark, path, 2, ["k"]).collect()) == [(1, "a"), (3, "c")]
    sinks.commit_snapshot(spark, df([(1, "a"), (2, "x")]), None, ["k"], "s", path, 1)  # the first version written anew, otherwise
    with pytest.raises(ValueError, match="snapshot 2"):
        sinks.restore_snapshot(spark, path, 2, ["k"])


def test_a_cluster_without_a_shared_folder_is_refused():
    from sightline.session import is_local

    assert is_local("local[4]") and is_local("local") and not is_local("local-cluster[3,2,900]") and not is_local("spark://host:7077") and not is_local("yarn")


def test_new_operators_of_nothing_and_nulls(spark):
    from sightline.operators import delivery, inference

    boxes = "k int, i int, x1 double, y1 double, x2 double, y2 double, width int, height int"
    none = spark.createDataFrame([], boxes)
    assert spatial.nearest(none, "k", "i", 3).count() == spatial.near_rows(none, "k", "i").count() == 0
    assert consensus.geometry_audit(none, none, ["k"], "i").count() == 0
    target = spark.createDataFrame([(1, 1, 0.0, 0.0, 9.0, 9.0, 50, 50), (None, 2, 0.0, 0.0, 9.0, 9.0, 50, 50), (3, 3, None, 0.0, 9.0, 9.0, 50, 50)], boxes)
    audit = {r["i"]: (r["box_count"], r["passed"], r["reason"]) for r in consensus.geometry_audit(target, target.filter("i <> 2"), ["k"], "i").collect()}
    assert audit == {1: (1, True, None), 2: (0, False, "no_valid_locator_box"), 3: (1, False, "locator_target_disagreement")}
    assert [r["i"] for r in delivery.inserted(target.unionByName(target), none, ["k"], ["i"]).orderBy("i").collect()] == [1, 2]
    assert folds.greedy(none, ["k"], "i", 0.5).count() == folds.greedy(none, ["k"], "i", 0.5, fold_rows=0).count() == 0
    found, markers = inference.ground(none.withColumnRenamed("i", "request_id"), ["k"], lambda batch: [])
    assert found.count() == markers.count() == 0
    state = spark.createDataFrame([], "id int, needed int, n int")
    assert relational.drained(state, F.col("n") < F.col("needed"), lambda d: d, 2).count() == 0
    rows = spark.createDataFrame([(None, 1, 1.0), (None, 2, None), (1, 1, 1.0)], "k int, i int, v double")
    assert relational.stale(rows, rows, ["k"], "i", "v").count() == 0
    assert sorted((r["k"] or 0, r["i"]) for r in relational.stale(rows, rows.filter("i = 1"), ["k"], "i", "v").collect()) == [(0, 1), (0, 2)]
    images = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "image_id string")
    objects = spark.createDataFrame([("a", "verified", "the x", None), ("a", None, None, None), ("a", "unresolved", "y", "r" * 2000)], "image_id string, status string, phrase string, reason string")
    empty = spark.createDataFrame([], "image_id string, open int, status string, reason string")
    six = delivery.fan_out(objects, empty, empty, images)
    assert sorted((r["image_id"] or "", r["final_count"], r["object_count"], r["unresolved_count"]) for r in six["counts_by_image"].collect()) == [("", 0, 0, 0), ("a", 1, 3, 2), ("b", 0, 0, 0)]
    assert sorted(len(r["reason"]) for r in six["unresolved"].collect()) == [len("no_phrase_before_search_drain_completed"), 1200]
