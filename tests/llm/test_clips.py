"""Capping, cutoffs, packing and splits against brute force, with dirt, ties, repeats, hot keys and empty tables."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import capping, cutoffs, packing, splits

META = "audio_file string, video_id string, speaker string, duration double, squim_mos double, emitted_at timestamp"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    """Rows without times get increasing ones."""
    out = [(*r[:5], i if len(r) < 6 else r[5]) for i, r in enumerate(rows)]
    raw = spark.createDataFrame(out, META.replace("timestamp", "long"))
    return raw.withColumn("emitted_at", F.timestamp_seconds("emitted_at"))


def dirty(seed, n=400, hot=0.5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        clip = rng.randrange(n)
        pick = random.Random(clip)
        speaker = "hot" if pick.random() < hot else pick.choice(["a", " A", "b", None, " ", "c"])
        rows.append((f"f{clip:04d}", pick.choice(["v", "w", "x", None]), speaker, rng.choice([None, NAN, INF, -1.0, 3.0, 3.0, 7.5, 31.0, 95.0]), rng.choice([None, NAN, INF, 0.5, 1.0, 2.0, 2.0, 3.3, 5.0, 9.0])))
    return rows


def current(rows):
    now = {}
    for r in rows:
        if r[0] is not None:
            now[r[0]] = r
    return list(now.values())


def usable(x):
    return x is not None and not math.isnan(x) and 1 <= x <= 5


@pytest.mark.parametrize("seed", [1, 2])
def test_capping(spark, seed):
    rows = dirty(seed)
    by = defaultdict(list)
    for f, _, who, d, m, *_ in current(rows):
        if who is not None and who.strip():
            by[who.strip().lower()].append((0 if usable(m) else 1, -m if usable(m) else 0, 1 if d is None or math.isnan(d) else 0, -d if d is not None and not math.isnan(d) else 0, f))
    want = {x[-1] for group in by.values() for x in sorted(group)[15:]}
    got = capping.capped_speakers(table(spark, rows), salts=3)
    assert {r["audio_file"] for r in got.filter("NOT kept").collect()} == want
    assert got.count() == len(current(rows))


def test_capping_by_share_and_ties(spark):
    df = spark.createDataFrame([(i, "a", 1, "x") for i in range(10)] + [(i, "b", 1, "x") for i in range(10, 13)] + [(20, None, 1, "x")], "id int, who string, c int, kept string")
    got = capping.cap_contributors(df, "who", [(F.col("id"), "asc")], cap=5, share=0.34, salts=2)
    assert sorted(r["id"] for r in got.filter("kept").collect()) == [0, 1, 2, 3, 10, 11, 20]
    assert got.columns == ["id", "who", "c", "kept"]


def test_capping_by_share_alone(spark):
    df = spark.createDataFrame([(i, "hot") for i in range(101)] + [(i, "b") for i in range(200, 203)] + [(300, None)], "id int, who string")
    kept = sorted(r["id"] for r in capping.cap_contributors(df, "who", [(F.col("id"), "asc")], None, 0.5).filter("kept").collect())
    assert kept == [*range(51), 200, 201, 300]
    assert capping.cap_contributors(df.limit(0), "who", [(F.col("id"), "asc")], None, 0.5).count() == 0
    with pytest.raises(ValueError, match="neither"):
        capping.cap_contributors(df, "who", [(F.col("id"), "asc")], None)


@pytest.mark.parametrize("seed", [1, 2])
def test_cutoffs(spark, seed):
    rows = dirty(seed)
    by = defaultdict(list)
    for f, v, _, _, m, *_ in current(rows):
        if v is not None and usable(m):
            by[v].append((m, f))
    want, cuts = set(), {}
    for v, scored in by.items():
        cut = sorted((m for m, _ in scored), reverse=True)[math.ceil(4 * len(scored) / 5) - 1]
        cuts[v] = (cut, len(scored), sum(m >= cut for m, _ in scored))
        want |= {(v, f) for m, f in scored if m < cut}
    assert {tuple(r) for r in cutoffs.below_cutoff(table(spark, rows)).collect()} == want
    assert {r["video_id"]: tuple(r)[1:] for r in cutoffs.cutoff_table(table(spark, rows)).collect()} == cuts


def test_oversized(spark):
    rows = dirty(3) + [("g1", "v", "a", 30.0, 1.0), ("g2", "v", "a", 1e300, 1.0), ("g3", "v", "a", 60.0, 1.0), ("g4", "v", "a", 60.0, 1.0), ("g4", "v", "a", 20.0, 1.0), (None, "v", "a", 60.0, 1.0)]
    want = {r[0] for r in current(rows) if r[3] is not None and math.isfinite(r[3]) and r[3] > 30}
    assert {r["audio_file"] for r in packing.oversized_clips(table(spark, rows)).collect()} == want


def check_packing(got, items, capacity):
    held = defaultdict(int)
    sums = defaultdict(int)
    own = set()
    for r in got:
        sums[r["id"]] += r["size"]
        if r["containers"] == 1 and r["size"] <= capacity and not (r["divided"] and r["size"] % capacity == 0):
            held[r["pack_group"], r["container"]] += r["size"]
        else:
            assert r["size"] == r["containers"] * capacity
            for k in range(r["containers"]):
                assert (r["pack_group"], r["container"] + k) not in own
                own.add((r["pack_group"], r["container"] + k))
    assert dict(sums) == dict(items) and max(held.values(), default=0) <= capacity and not own & set(held)
    return len(held) + len(own)


def test_packing(spark):
    rng = random.Random(5)
    items = [(f"i{k}", rng.choice([1, 5, 30, 31, 60, 75, rng.randrange(1, 200)])) for k in range(500)]
    got = packing.pack_items(spark.createDataFrame(items, "id string, size long"), 30, groups=2).collect()
    check_packing(got, items, 30)
    assert packing.pack_items(spark.createDataFrame([], "id string, size long"), 30).count() == 0


def test_packing_report(spark):
    rows = [(f"f{i}", "v", "a", d, 1.0) for i, d in enumerate([29.0, 1.0, 31.0, 90.0, 0.5, 12.0, None, NAN, -1.0] * 20)]
    assert tuple(packing.packing_report(table(spark, rows)).first()) == (120, 0, 0, True)


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    for low, high, slack in ((500, 12_000, 1.01), (100, 30_000, 1.06)):
        sizes = rng.integers(low, high, 5000)
        place, bins = packing.pack_sizes(sizes, 30_000)
        load = np.bincount(place, weights=sizes, minlength=bins)
        assert load.max() <= 30_000 and (load > 0).all() and bins <= slack * np.ceil(sizes.sum() / 30_000) + 1
    assert packing.pack_sizes(np.array([30, 30]), 30)[1] == 2


def components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for v, who in pairs:
        a = find((0, v))
        if who is not None and who.strip():
            b = find((1, who.strip().lower()))
            parent[max(a, b)] = min(a, b)
    return {(v, find((0, v))[1]) for v, _ in pairs}


def test_groups(spark):
    rng = random.Random(7)
    chain = [(f"c{i:03d}", f"l{j}") for i in range(60) for j in (i, i + 1)]
    pairs = chain + [(f"v{rng.randrange(80):02d}", rng.choice([f"p{rng.randrange(60)}", f" P{rng.randrange(60)} ", None, ""])) for _ in range(120)] + [(f"h{i}", "hub") for i in range(50)]
    rows = [(f"f{i}", v, who, 1.0, 1.0) for i, (v, who) in enumerate(pairs)] + [("n", None, "hub", 1.0, 1.0)]
    want = components(pairs)
    assert {tuple(r) for r in splits.video_groups(table(spark, rows)).collect()} == want
    assert {tuple(r) for r in splits.grouped_videos(table(spark, rows)).collect()} == want


def test_empty_tables(spark):
    empty = table(spark, []) if False else spark.createDataFrame([], META)
    for f in (capping.capped_speakers, cutoffs.below_cutoff, cutoffs.cutoff_table, packing.pack_clips, packing.oversized_clips, splits.video_groups, splits.grouped_videos, splits.split_clips):
        assert f(empty).count() == 0


def test_clashing_columns(spark):
    extra = table(spark, dirty(9, 60)).withColumns({c: F.lit(1) for c in ("row", "rank", "salt", "part", "size", "component", "split", "kept", "SPEAKER_ID")})
    plain = table(spark, dirty(9, 60))
    for f in (capping.capped_speakers, cutoffs.below_cutoff, packing.oversized_clips, splits.grouped_videos):
        assert sorted(map(str, f(extra).collect())) == sorted(map(str, f(plain).collect()))


def test_split_shares(spark):
    rows = [(f"f{i:05d}", f"v{i // 4}", f"s{i // 4}", 1.0, 1.0) for i in range(4000)] + [(f"g{i:04d}", f"x{i}", "host", 1.0, 1.0) for i in range(1000)]
    config = splits.SplitConfig(large=50, buckets=64)
    got = splits.split_clips(table(spark, rows), config=config)
    n = {r["split"]: r["n"] for r in got.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(n["train"] - 4000) <= 8 and abs(n["validation"] - 500) <= 8 and abs(n["test"] - 500) <= 8
    assert got.join(table(spark, rows).filter("speaker = 'host'"), "audio_file").select("split").distinct().count() == 1


def test_batches_keep_splits_and_quarantine_clashes(spark, tmp_path):
    config = splits.SplitConfig()
    store = splits.SplitStore(spark, str(tmp_path / "store"), config)
    first = table(spark, [(f"f{i}", f"v{i}", f"s{i}", 1.0, 1.0) for i in range(40)])
    store.update(splits.pair_edges(first))
    before = {r["video_id"]: r["split"] for r in store.assign(first).collect()}
    assert set(before.values()) == {"train", "validation", "test"}
    a, b = next(v for v in before if before[v] == "train"), next(v for v in before if before[v] == "test")
    same = [v for v in before if before[v] == "train"][1]
    late = table(spark, [("n1", "new1", "s" + a[1:], 1.0, 1.0), ("n2", "new2", "s" + a[1:], 1.0, 1.0), ("n3", "new2", "s" + b[1:], 1.0, 1.0), ("n4", a, "s" + same[1:], 1.0, 1.0), ("n5", "solo", "solo", 1.0, 1.0)])
    store.update(splits.pair_edges(late))
    after = {r["video_id"]: r["split"] for r in store.assign(first).collect()}
    assert after == before and store.version() == 2
    got = {r["audio_file"]: r["split"] for r in store.assign(late).collect()}
    assert got["n2"] == got["n3"] == "quarantine" and got["n4"] == "train" and got["n5"] in before.values()
    everything = first.unionByName(late)
    placed = store.assign(everything).filter("split <> 'quarantine'")
    for key in ("video_id", "speaker"):
        assert placed.groupBy(key).agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


def test_only_what_ties_two_splits_is_quarantined(spark, tmp_path):
    store = splits.SplitStore(spark, str(tmp_path / "store"))
    first = table(spark, [(f"f{i}", f"v{i}", f"s{i}", 1.0, 1.0) for i in range(40)])
    store.update(splits.pair_edges(first))
    before = {r["video_id"]: r["split"] for r in store.assign(first).collect()}
    a, b = next(v[1:] for v in before if before[v] == "train"), next(v[1:] for v in before if before[v] == "test")
    late = [(f"n{i}", f"one{i}", "s" + a, 1.0, 1.0) for i in range(20)] + [("m1", "two", "s" + a, 1.0, 1.0), ("m2", "two", "s" + b, 1.0, 1.0)]
    late += [("c1", "left", "s" + a, 1.0, 1.0), ("c2", "left", "mid", 1.0, 1.0), ("c3", "right", "mid", 1.0, 1.0), ("c4", "right", "s" + b, 1.0, 1.0), ("old", "v" + a, "s" + b, 1.0, 1.0)]
    store.update(splits.pair_edges(table(spark, late)))
    got = {r["audio_file"]: r["split"] for r in store.assign(table(spark, late)).collect()}
    assert all(got[f"n{i}"] == "train" for i in range(20))
    assert {got[k] for k in ("m1", "m2", "c1", "c2", "c3", "c4", "old")} == {"quarantine"}
    # a quarantined voice ties nothing later on
    more = table(spark, [("q1", "fresh", "mid", 1.0, 1.0), ("q2", "fresh", "s" + a, 1.0, 1.0), ("q3", "alone", "mid", 1.0, 1.0), ("q4", "alone", "own", 1.0, 1.0)])
    store.update(splits.pair_edges(more))
    got = {r["audio_file"]: r["split"] for r in store.assign(more).collect()}
    assert got["q1"] == got["q3"] == "quarantine" and got["q2"] == "train" and got["q4"] in ("train", "validation", "test")
    assert {r["video_id"]: r["split"] for r in store.assign(first).collect()} == before
    groups = dict(map(tuple, store.groups().collect()))
    assert groups["two"] == groups["v" + a] == groups["v" + b] == groups["right"] == groups["fresh"]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_over_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"f{i}", rng.choice([f"v{rng.randrange(90)}", None] + ["v1"] * (i % 3)), rng.choice([f"s{rng.randrange(90)}", None]), 1.0, 1.0) for i in range(160)]
    store = splits.SplitStore(spark, str(tmp_path / "store"), splits.SplitConfig(compact_every=2))
    kept = {}
    for n in range(4):
        batch = table(spark, rows[n * 40 : n * 40 + 40])
        store.update(splits.pair_edges(batch))
        now = {(r["kind"], r["node"]): r["split"] for r in store.nodes().collect()}
        assert all(now[k] == s for k, s in kept.items())
        kept = now
    pairs = [(r[1], r[2]) for r in rows]
    by_video = {v: g for v, g in components([(v, w) for v, w in pairs if v is not None])}
    assert dict(map(tuple, store.groups().collect())) == by_video
    placed = store.assign(table(spark, rows)).filter("split <> 'quarantine'")
    for key in ("video_id", "speaker"):
        assert placed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


def test_clips_without_video_or_label(spark):
    rows = [(f"f{i}", None, f"w{i % 7}", 1.0, 1.0) for i in range(70)] + [(f"g{i}", None, " ", 1.0, 1.0) for i in range(300)]
    got = splits.split_clips(table(spark, rows)).collect()
    n = defaultdict(int)
    for r in got:
        n[r["split"]] += 1
    assert len(got) == 370 and set(n) == {"train", "validation", "test"} and 200 < n["train"] < 340


def test_sizes_count_current_clips(spark):
    rows = [("f1", "v1", "a", 1.0, 1.0), ("f1", "v1", "b", 1.0, 1.0), ("f1", "v2", "b", 1.0, 1.0), ("f2", "v2", None, 1.0, 1.0), (None, "v3", "b", 1.0, 1.0)]
    assert sorted(map(tuple, splits.pair_edges(table(spark, rows)).collect()), key=str) == sorted([("v1", "a", 0), ("v1", "b", 0), ("v2", "b", 1), ("v2", None, 1), ("v3", "b", 0)], key=str)


def test_report(spark):
    rows = [(f"f{i}", f"v{i // 3}", f"s{i // 7}", 1.0, 1.0) for i in range(300)]
    assert tuple(splits.split_report(table(spark, rows)).first()) == (300, 0, 0, 0, True)
