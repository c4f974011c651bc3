"""Hand-made cases and properties of the operators."""

import json

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipyard.functions import arrays as A
from clipyard.functions import text as X
from clipyard.operators import clips as C
from clipyard.operators import features as E
from clipyard.operators import manifest as M
from clipyard.operators import onsets as O
from clipyard.operators import runs as U
from clipyard.operators import sets as S
from clipyard.operators import stats as Z
from clipyard.plans import compute, ingest  # noqa: F401  they register their queries
from clipyard.plans.registry import QUERIES, SQL
from clipyard.sources import readers as R
from clipyard.sources import sinks as K
from clipyard.streaming import streams as T


def lists(df):
    return sorted(map(tuple, df.collect()))


def test_sequence_plan_golden_values(spark):
    df = C.sequence_plan(spark.range(1), F.lit(8.0), {"16k": (16_000, 256), "44k": (44_100, 512)})
    assert {r.variant: (r.latent_len, r.clip_len, r.sync_len, r.audio_frames) for r in df.collect()} == {"16k": (250, 64, 192, 128_000), "44k": (345, 64, 192, 353_280)}


def test_manifest_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("id\tcaption\n00008004\ta, b\n7\t\n")
    assert lists(R.read_manifest(spark, str(tmp_path / "m.tsv")))[0] == ("00008004", "a, b")


def test_loose_manifest(spark, tmp_path):
    p = tmp_path / "m.tsv"
    for text, want in [
        ("ID\tx\na\tdog\n\nb\t \nc\n", [("a", "dog"), ("b", "d"), ("c", "d")]),
        ("a\tdog\nb\tcaption\n", [("a", "dog"), ("b", "caption")]),
        ("v\n", [("v", "d")]),
    ]:
        p.write_text(text)
        assert lists(R.read_loose_manifest(spark, str(p), "d")) == want


def test_packed_prompts_read_like_loose_ones(spark, tmp_path):
    """Null, spread over lines, broken, with a name of dots: the same from packed documents, and a query writes no file a document."""
    docs = {"a.json": '{"audio_prompt": "x"}', "b.c.json": '{\n "id": 1,\n "audio_prompt": "y \\"z\\""}', "d.json": '{"id": 2}', "e.json": '{"audio_prompt": null}', "f.json": '{"audio_prompt": '}
    for name, text in docs.items():
        (tmp_path / name).write_text(text)
    loose = R.read_prompt_json(spark, str(tmp_path)).collect()
    rows = spark.createDataFrame([(f"x/y/{k}", v) for k, v in docs.items()], "path string, text string")
    key = lambda r: (r[0], r[1] or "")
    assert sorted(map(tuple, R.packed_prompts(rows).collect()), key=key) == sorted(map(tuple, loose), key=key)
    spark.createDataFrame([(i, None if i == 7 else f"s {i}") for i in range(300)], "s_suppkey long, s_name string").repartition(2).write.parquet(str(tmp_path / "supplier.parquet"))
    got = QUERIES["s5_prompt_json"](spark, str(tmp_path))
    assert len(got.inputFiles()) < 20 and {(r.name, r.audio_prompt) for r in got.collect()} == {(str(i), None if i == 7 else f"s {i}") for i in range(300)}


def test_prompt_json_and_inventory(spark, tmp_path):
    for name in ("b.json", "a.json"):
        (tmp_path / name).write_text(json.dumps({"audio_prompt": name[0] * 3}, indent=1))
    (tmp_path / "c.MP4").write_bytes(b"x" * 10)
    assert lists(R.read_prompt_json(spark, str(tmp_path / "*.json"))) == [("a", "aaa"), ("b", "bbb")]
    inv = R.media_inventory(spark, str(tmp_path), [".mp4"]).select("stem", "ext", "length")
    assert lists(inv) == [("c", ".mp4", 10)]


def test_onset_times_stop_at_duration(spark, tmp_path):
    (tmp_path / "x_times.txt").write_text("0.5 a\n7.9 b\n8.0 c\n1.0 d\n")
    (tmp_path / "y_times.txt").write_text("")
    assert lists(R.read_onset_times(spark, str(tmp_path), 8.0).select("file", "time")) == [("x_times", 0.5), ("x_times", 7.9)]


def test_load_shards_fails_on_missing_and_repeated(spark):
    feats = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id long, x string")
    ids = lambda *v: spark.createDataFrame([(i, p) for p, i in enumerate(v)], "id long, pos int")
    assert [r.x for r in R.load_shards(feats, ids(1)).collect()] == ["a"]
    for bad in (3, 2):
        with pytest.raises(Exception, match="missing id|repeated id"):
            R.load_shards(feats, ids(bad)).collect()


def test_shard_order_is_numeric(spark):
    df = spark.createDataFrame([("r0_10",), ("r0_2",), ("r1_0",)], "f string")
    assert [r.f for r in df.orderBy(R.shard_order("f")).collect()] == ["r0_2", "r0_10", "r1_0"]


def test_resolve_paths(spark):
    inv = spark.createDataFrame([("a.mp4",), ("b.mov",), ("b.mp4",), ("c.xyz",), ("d.xyz",), ("d.abc",), ("e",)], "name string")
    inv = inv.select("name", X.file_stem(F.col("name")).alias("stem"), X.file_ext(F.col("name")).alias("ext"), F.concat(F.lit("/m/"), "name").alias("path"))
    man = spark.createDataFrame([(i,) for i in ("a.mp4", "b", "c", "d", "e", "f", "g.mp4")], "id string")
    got = {r.id: r.path for r in M.resolve_paths(man, inv, [".mp4", ".mov"]).collect()}
    assert got == {"a.mp4": "/m/a.mp4", "b": "/m/b.mp4", "c": "/m/c.xyz", "d": None, "e": "/m/e", "f": None, "g.mp4": None}


def test_rate_and_captions(spark):
    df = spark.createDataFrame([("30000/1001",), ("25",), (None,), ("x",), ("1/0",)], "r string").select(X.parse_rate(F.col("r")).alias("v"))
    assert [round(r.v, 3) for r in df.collect()] == [29.97, 25.0, 29.97, 29.97, 29.97]
    df = spark.createDataFrame([(" ",), (None,), (" a ",)], "c string").select(X.fill_caption(F.col("c"), "d").alias("v"))
    assert [r.v for r in df.collect()] == ["d", "d", "a"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 400_000), min_size=1, max_size=30))
def test_clips_stay_inside(spark, totals):
    df = spark.createDataFrame(list(enumerate(totals)), "id long, n long")
    by = {str(i): n for i, n in enumerate(totals)}
    seg = int(8000 * 8.1)
    for r in C.partition_clips(df, "id", "n", 8000).collect():
        assert 0 <= r.start_sample and r.end_sample <= by[r.name] and r.end_sample - r.start_sample == seg


@pytest.mark.parametrize("n", [0, 15, 16, 23, 24, 192, 200])
def test_sliding_segment_count(spark, n):
    df = spark.range(1).select(A.sliding_segments(F.array_repeat(F.lit(1.0), n)).alias("s"))
    assert len(df.first().s) == max(0, (n - 16) // 8 + 1)


def test_fit_length_and_indices(spark):
    row = spark.range(1).select(
        A.fit_length(F.array(*map(F.lit, (1.0, 2.0))), 4).alias("a"), A.fit_length(F.array(*map(F.lit, (1.0, 2.0))), 3, "zero").alias("b"),
        A.fit_length(F.array(*map(F.lit, (1.0, 2.0))), 1).alias("c"), A.uniform_indices(F.lit(1), 3).alias("d"), A.uniform_indices(F.lit(10), 4, "floor").alias("e"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e) == ([1, 2, 2, 2], [1, 2, 0], [1], [0, 0, 0], [0, 3, 6, 9])


def test_waves(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.5, -1.0],)], "w array<double>")
    got = df.select(A.is_silent(F.col("w")).alias("s"), A.peak_normalize(F.col("w")).alias("p")).collect()
    assert [r.s for r in got] == [True, False] and got[1].p == [0.475, -0.95] and got[0].p == [None, None]
    two = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],), ([[float(i), 0.0] for i in range(9)],)], "c array<array<double>>").select(A.to_mono(F.col("c")).alias("m")).collect()
    assert two[0].m == [2.0, 4.0] and two[1].m == [i / 2 for i in range(9)]


def test_clock_resampling(spark):
    for fps in (10, 30):
        frames = spark.createDataFrame([("v", i / fps, i) for i in range(fps * 2)], "v string, time double, idx long")
        ticks = C.clock_ticks(spark.createDataFrame([("v", 2.0)], "v string, d double"), "v", 8.0, F.col("d"))
        got = C.resample_clock(frames, ticks, "v", "time", "idx").orderBy("tick_time").collect()
        want = [next((i for i in range(fps * 2) if i / fps >= k / 8), None) for k in range(16)]
        assert [r.idx for r in got] == [w for w in want if w is not None]


def test_nearest_frame_ties_go_down(spark):
    f = spark.createDataFrame([("a", 2), ("a", 6)], "k string, idx long")
    q = spark.createDataFrame([("a", i) for i in (0, 4, 5, 9)] + [("b", 1)], "k string, idx long")
    assert lists(C.nearest_frame(q, f, "k")) == [("a", 0, 2), ("a", 4, 2), ("a", 5, 6), ("a", 9, 6), ("b", 1, None)]


def test_combine_shards_first_wins(spark):
    df = spark.createDataFrame([(1, 0, 10, "late"), (1, 0, 2, "first"), (2, 0, 2, "x")], "id long, rank long, batch long, v string")
    rows, n = S.combine_shards(df, "id", ["rank", "batch"])
    assert {r.id: r.v for r in rows.collect()} == {1: "first", 2: "x"} and n.first()[0] == 1
    assert S.combine_shards(df, "id", dedup=False)[0].count() == 3


@pytest.mark.parametrize("n,world", [(0, 3), (1, 4), (10, 3), (12, 4)])
def test_rank_assignment(spark, n, world):
    got = S.assign_rank(spark.range(n).withColumnRenamed("id", "pos"), "pos", world).toPandas()
    assert len(got) == -(-n // world) * world and set(got["pos"]) == set(range(n))
    assert n == 0 or got.groupby("rank").size().nunique() == 1


def test_global_index_is_dense(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("dataset_ord"), F.col("id"))
    got = S.global_index(df, "id").orderBy("dataset_ord", "id").toPandas()
    assert got["global_idx"].tolist() == list(range(1000))
    assert (got.groupby("dataset_ord")["sample_idx"].max() + 1 == got.groupby("dataset_ord").size()).all()


def test_stats_match_numpy(spark):
    x = np.random.default_rng(0).normal(size=(20, 3, 4))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "latent array<array<double>>")
    got = Z.latent_stats(df, "latent").orderBy("channel").toPandas()
    assert np.allclose(got["mean"], x.reshape(-1, 4).mean(axis=0)) and np.allclose(got["std"], x.reshape(-1, 4).std(axis=0, ddof=1))


def test_frechet_of_equal_and_shifted_sets(spark):
    x = np.random.default_rng(1).normal(size=(50, 3))
    df = lambda v: spark.createDataFrame([(r.tolist(),) for r in v], "e array<double>")
    assert abs(Z.compare_embeddings(df(x), df(x), "e", 3)["frechet"]) < 1e-6
    assert abs(Z.compare_embeddings(df(x), df(x + 2), "e", 3)["frechet"] - 12) < 1e-6


def test_binned_mean_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 0.97), (5.0, 0.0)], "v double, t double")
    assert lists(Z.binned_mean(df, "v", F.col("t"))) == [(0, 5.0, 1), (24, 2.0, 2)]


def test_interval_ema_by_hand(spark):
    df = spark.createDataFrame([("a", float(t)) for t in (0, 5, 7, 10, 11)] + [("b", 0.0), ("b", 4.0), ("c", 1.0)], "run string, t double")
    got = {r.run: r for r in U.interval_ema(df, "run", F.col("t"), 0.7, 100, 2).collect()}
    assert abs(got["a"].ema - (0.7 * (0.7 * 2 + 0.3 * 3) + 0.3 * 1)) < 1e-9 and got["b"].ema == 4.0 and "c" not in got


def test_suppression_and_matching(spark):
    pred = spark.createDataFrame([("a", 1.0, 0.5), ("a", 1.02, 0.9), ("a", 1.06, 0.5), ("b", 3.0, 0.4)], "file string, pos double, conf double")
    assert lists(O.suppress(pred, 0.05).select("file", "pos")) == [("a", 1.02), ("b", 3.0)]
    truth = spark.createDataFrame([("a", 1.0), ("a", 1.05), ("a", 9.0), ("c", 1.0)], "file string, pos double")
    got = lists(O.match_onsets(pred, truth, 0.3))
    assert got == [("a", 0, 0.5, False), ("a", 1, 0.0, False), ("a", 1, 0.5, True), ("a", 1, 0.9, True), ("b", 0, 0.4, False), ("c", 1, 0.0, False)]
    one = pred.filter("file = 'b'")
    assert O.match_onsets(one.withColumn("file", F.lit("c")).withColumn("pos", F.lit(1.0)), truth.filter("file = 'c'").unionAll(spark.createDataFrame([("c", 5.0)], truth.schema)), 0.3, compat=True).count() == 1


@pytest.mark.parametrize("size", [5, 1_000_000])
def test_greedy_steps_in_chunks_are_those_of_whole_files(spark, size):
    rng = np.random.default_rng(1)
    rows = [(f"f{i % 2}", float(x), float(c), i) for i, (x, c) in enumerate(zip(np.round(rng.uniform(0, 60, 300), 3), rng.integers(0, 40, 300), strict=True))]
    pred = spark.createDataFrame(rows, "file string, pos double, conf double, id long")
    truth = spark.createDataFrame([(f"f{i % 2}", float(x)) for i, x in enumerate(np.round(rng.uniform(0, 60, 80), 3))], "file string, pos double")
    kept, matched, published = [], [], []
    for f in ("f0", "f1"):
        own: list = []
        for r in sorted((r for r in rows if r[0] == f), key=lambda r: (-r[2], -r[1])):
            if all(abs(r[1] - k[1]) >= 0.2 for k in own):
                own.append(r)
        kept += own
        free = [(r[1], r[2]) for r in rows if r[0] == f]
        for g in sorted(t.pos for t in truth.collect() if t.file == f):
            near = [x for x in free if abs(x[0] - g) < 0.2]
            best = max(near, key=lambda x: (x[1], x[0]), default=None)
            matched.append((f, 1, best[1] if best else 0.0, bool(best)))
            if best:
                free.remove(best)
        matched += [(f, 0, c, False) for _, c in free]
    assert lists(O.suppress(pred, 0.2, size=size)) == sorted(kept)
    for rounds, passes in ((1, 3), (2, 1), (4, 8)):
        assert lists(O.suppress(pred, 0.2, size=size, rounds=rounds, passes=passes)) == sorted(kept)
    assert lists(O.match_onsets(pred, truth, 0.2, size=size)) == sorted(matched)
    few = pred.filter("id % 25 = 0")
    got = lists(O.match_onsets(few, truth, 3.0, compat=True, size=size))
    for f in ("f0", "f1"):
        free = [(r[1], r[2]) for r in rows if r[0] == f and r[3] % 25 == 0]
        for g in sorted(t.pos for t in truth.collect() if t.file == f):
            near = [x for x in free if abs(x[0] - g) < 3.0]
            best = max(near, key=lambda x: (x[1], x[0]), default=None)
            published.append((f, 1, best[1] if best else 0.0, bool(best)))
            if best:
                free.remove(best)
            if best and not free:
                break
        published += [(f, 0, c, False) for _, c in free]
    assert got == sorted(published)
    apart = []
    for f in ("f0", "f1"):
        last = None
        for p in sorted({r[1] for r in rows if r[0] == f}):
            if last is None or p > last + 0.25:
                apart.append((f, p))
                last = p
    assert sorted((r.file, r.pos) for r in O.keep_apart(pred, "file", "pos", 0.25, size).collect()) == sorted(apart)
    got = [(r.file, r.pred_id, r.truth_pos) for r in O.onset_candidates(pred, truth, 0.2, cell=max(1, size // 5)).collect()]
    assert sorted(got) == sorted((r[0], r[3], t.pos) for r in rows for t in truth.collect() if t.file == r[0] and abs(r[1] - t.pos) < 0.2)


def test_suppression_of_rising_chains_and_odd_rows(spark):
    """Confidence that rises along a gapless file takes as many rounds as it is long; the last passes leave the rest to one task."""
    rising = spark.range(300).select(F.lit("a").alias("file"), (F.col("id") * 0.1).alias("pos"), F.col("id").cast("double").alias("conf"))
    got = sorted(r.pos for r in O.suppress(rising, 0.15, size=20, rounds=1, passes=3).collect())
    assert got == [i * 0.1 for i in range(1, 300, 2)]
    odd = spark.createDataFrame([("a", 1.0, 0.5, 1), ("a", 1.0, 0.7, 2), ("a", 1.0, 0.7, 3), ("a", 2.0, 0.7, 4), ("a", None, 0.9, 5), ("a", 1.1, None, 6), (None, 1.0, 0.1, 7)], "file string, pos double, conf double, `p.q` int")
    assert sorted((r.file or "", r.pos, r.conf) for r in O.suppress(odd, 1.0).collect()) == [("", 1.0, 0.1), ("a", 1.0, 0.7), ("a", 2.0, 0.7)]
    assert O.suppress(odd.limit(0), 1.0).count() == 0


def test_truth_pairs_and_candidates_keep_their_columns(spark):
    pred = spark.createDataFrame([("a_denoised", 1), ("b_denoised", 2), ("c", 3)], "name string, x int")
    truth = spark.createDataFrame([("a_times", 7), ("c", 8)], "name string, y int")
    assert lists(O.pair_truth(pred, truth).select("pred_name", "pred_x", "truth_y")) == [("a_denoised", 1, 7), ("c", 3, 8)]
    p = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 2)], "file string, pos double, id int")
    t = spark.createDataFrame([("a", 1.1, 5), ("a", 1.1, 6), ("a", 2.5, 7)], "file string, pos double, id int")
    assert lists(O.onset_candidates(p, t, 0.5).select("pred_id", "truth_id")) == [(1, 5), (1, 6), (2, 5), (2, 6)]


def test_lookup_counts_and_lengths(spark):
    rows = S.global_index(spark.createDataFrame([(0, 5), (1, 1), (0, 3)], "dataset_ord int, id int"), "id")
    assert lists(S.lookup_index(rows, spark.createDataFrame([(0,), (-1,), (9,)], "i int")).select("i", "id")) == [(-1, 1), (0, 3)]
    assert lists(S.batch_counts(spark.range(10), 4, 2, False)) == [(3, 2)] and lists(S.batch_counts(spark.range(10), 4, 2, True)) == [(2, 2)]
    assert lists(M.missing_counts(spark.range(5), spark.createDataFrame([(1,), (1,), (9,)], "id long"))) == [(5, 1, 4)]
    w = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0]), (3, None)], "id int, w array<double>")
    assert lists(C.require_samples(w, "w", 2)) == [(1, [1.0, 2.0])]
    quiet = spark.createDataFrame([([0.5],), ([0.2],)], "w array<double>").select(A.is_silent(F.col("w"), 0.5).alias("a"), A.is_silent(F.col("w"), 0.5, inclusive=True).alias("b"))
    assert lists(quiet) == [(False, True), (True, True)]


def test_average_precision_perfect_and_empty(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 0, 0.5)], "f string, y int, score double")
    got = {r.f: (r.ap, round(r.f1, 4)) for r in O.average_precision(df, "f").collect()}
    assert got == {"a": (1.0, 0.6667), "b": (0.0, 0.0)}


def test_confidence_at_the_start(spark):
    row = spark.range(1).select(O.onset_confidence(F.array(*map(F.lit, (0.1, 0.9, 0.3, 1.0))), F.lit(0), 2).alias("c")).first()
    assert row.c == 0.9


def test_peaks_keep_apart(spark):
    v = [0, 0, 5, 0, 5, 0, 0, 0, 0, 6, 0, 0]
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate(v)], "f string, pos long, v double")
    assert [r.pos for r in O.pick_onsets(df, "f", "pos", "v", 2.0, 1, 5, 3).orderBy("pos").collect()] == [2, 9]


def test_peaks_at_the_threshold_and_at_one_place(spark, tmp_path):
    """A value of exactly 30 above the mean is a peak whatever the order of summing; of equal places the largest goes on."""
    rng, rows = np.random.default_rng(3), []
    for user in range(300):
        v = np.round(rng.uniform(0, 20, 21), 2)
        rest = int(round(100 * (v.sum() - v[10])))
        v[0] = (v[0] * 100 + (-rest) % 20) / 100  # so that the value at the threshold has two decimals
        v[10] = (int(round(100 * (v.sum() - v[10]))) + 63_000) // 20 / 100
        rows += [(user, i, float(x)) for i, x in enumerate(np.round(v, 2))]
    rows += [(900, 5, x) for x in [90.0, *[1.0] * 9, 80.0, 90.0]] + [(901, i, x) for i, x in enumerate([float("nan"), 1.0, 2.0, 90.0, None, float("inf"), 1e300, *[0.0] * 9, 70.0])] + [(902, None, 60.0), (902, None, 1.0), (902, 3, 0.0), (None, 4, 50.0), (None, 1, 0.0), (None, 2, 0.0)]
    spark.createDataFrame(rows, "user_id long, event_id long, value double").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("o1_pick_peaks", "o1_pick_onsets"):
        got = QUERIES[name](spark, str(tmp_path)).collect()
        assert {(r.user_id, r.event_id) for r in got if r.user_id is not None and r.user_id < 300} >= {(u, 10) for u in range(300)}
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(SQL[name]).fetchall()))
        assert [tuple(r) for r in got if r.user_id == 900] == [(900, 5, 90.0)] * (2 if name == "o1_pick_peaks" else 1)


def test_resampled_tone_and_mel(spark):
    rate = 16_000
    wave = np.sin(2 * np.pi * 440 * np.arange(rate) / rate)
    down = E.resample_wave(wave, rate, 8000)
    want = np.sin(2 * np.pi * 440 * np.arange(8000) / 8000)
    assert len(down) == 8000 and np.abs(down - want)[200:-200].max() < 1e-2
    mel = E.log_mel_frames(wave, "16k")
    assert mel.shape == (80, rate // 256) and mel.mean(axis=1).argmax() in range(8, 20)
    df = spark.createDataFrame([(1, wave.tolist()), (2, [0.0])], "id long, samples array<double>")
    assert {r.id: r.frames for r in E.log_mel(df, "16k").collect()} == {1: rate // 256, 2: 0}


@pytest.mark.parametrize("source,size", [(16_000, 700), (22_050, 1001), (44_100, 3000), (8_000, 50), (11_025, 999)])
def test_chunked_resampling_is_that_of_the_whole(spark, source, size):
    rng = np.random.default_rng(source)
    waves = {"a": rng.normal(size=5 * size + 3), "b": rng.normal(size=size), "c": rng.normal(size=2 * size + 1), "d": rng.normal(size=5)}
    df = spark.createDataFrame([(k, source, v.tolist(), 7) for k, v in waves.items()] + [("e", source, [], 7), ("f", source, None, 7)], "id string, sample_rate int, samples array<double>, more int")
    out = E.resample_chunks(E.cut_wave(df, size, carry=["sample_rate", "more"]), 8_000, size).orderBy("id", "chunk").collect()
    got = {k: np.concatenate([np.array(r.samples) for r in out if r.id == k]) for k in waves}
    assert {r.id for r in out} == set(waves) and {(r.sample_rate, r.more) for r in out} == {(8_000, 7)}
    for k, v in waves.items():
        want = E.resample_wave(v, source, 8_000)
        assert len(got[k]) == len(want) and np.abs(got[k] - want).max(initial=0) < 1e-9


@pytest.mark.parametrize("size", [1024, 1500, 4096])
def test_chunked_log_mel_is_that_of_the_whole(spark, size):
    rng = np.random.default_rng(size)
    waves = {"a": rng.normal(size=9000) / 3, "b": rng.normal(size=4 * size) / 3, "c": rng.normal(size=3 * size + 10) / 3, "d": rng.normal(size=400) / 3, "short": rng.normal(size=300)}
    df = spark.createDataFrame([(k, v.tolist()) for k, v in waves.items()], "id string, samples array<double>")
    out = E.log_mel_chunks(E.cut_wave(df, size), "16k", size).orderBy("id", "first_frame").collect()
    assert {r.id for r in out} == set(waves) - {"short"}
    for k in set(waves) - {"short"}:
        got = np.concatenate([np.array(r.mel) for r in out if r.id == k])
        assert np.abs(got - E.log_mel_frames(waves[k], "16k").T).max() < 1e-9


def test_moments_far_from_zero_and_a_second_way_to_the_score(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 1e6, rng.normal(size=(200, 6)) * 2 + 1e6 + 1
    df = lambda v: spark.createDataFrame([(r.tolist(),) for r in v] + [(None,), ([1.0],)], "e array<double>").repartition(40)
    n, mean, c = Z.centred_moments(df(x), "e", 6, fan_in=3)
    assert n == 300 and np.abs(mean - x.mean(axis=0)).max() < 1e-8 and np.abs(c / 299 - np.cov(x.T)).max() < 1e-6
    c1, c2 = np.cov(x.T), np.cov(y.T)
    root = np.sqrt(np.maximum(np.linalg.eigvals(c1 @ c2).real, 0)).sum()  # the trace of the root of the product
    want = ((x.mean(axis=0) - y.mean(axis=0)) ** 2).sum() + np.trace(c1) + np.trace(c2) - 2 * root
    assert abs(Z.compare_embeddings(df(x), df(y), "e", 6)["frechet"] - want) < 1e-4
    none = df(x).limit(0)
    assert Z.centred_moments(none, "e", 6)[0] == 0 and Z.moments(none, "e", 2).count() == 4


def test_quarantine_of_items(spark):
    def make():
        def encode(b):
            if b["x"].isna().any():
                raise ValueError("none")
            return pd.DataFrame({"y": b["x"] * 2})

        return encode

    df = spark.createDataFrame([(i, None if i == 3 else i) for i in range(8)], "id long, x long")
    got = {r.id: (r.y, r.error) for r in E.extract_features(df, make, "y long", batch=4).collect()}
    assert got[3] == (None, "ValueError: none") and all(got[i] == (2 * i, None) for i in range(8) if i != 3)


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id long, n long, caption string")
    assert C.partition_clips(none, "id", "n", 100).count() == 0
    assert S.epoch_order(none, "id", 1, 1).count() == 0
    assert Z.duplicate_audit(none, "id").first()["rows"] == 0
    ok, bad = K.split_errors(none, F.when(F.col("n") < 1, "x"))
    assert ok.count() == bad.count() == 0


def test_streaming_late_rows_and_first_id(spark, tmp_path):
    src = str(tmp_path / "in")
    batches = [
        [("a", "x", "2024-01-01 00:00:10", 1.0, 1), ("a", "x", "2024-01-01 00:00:50", 3.0, 2), ("b", "x", "2024-01-01 00:01:10", 5.0, 3)],
        [("a", "x", "2024-01-01 02:00:00", 7.0, 4), ("b", "x", "2024-01-01 00:01:20", 7.0, 5)],
        [("c", "x", "2024-01-01 02:00:30", 1.0, 8)],  # late rows go by the mark that the batch before began with
        [("a", "x", "2024-01-01 00:00:20", 900.0, 6), ("c", "x", "2024-01-01 02:01:00", 1.0, 7)],
    ]
    for rows in batches:
        df = spark.createDataFrame(rows, "run string, tag string, ts string, value double, id long").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = {}
    for name, s in (("means", T.stream_metric_means(stream, "1 minute")), ("ids", T.stream_manifest(stream.select("run", "ts", "id"), "4 hours", "run"))):
        with T.state_store(spark):
            q = s.writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start()
            q.awaitTermination()
        out[name] = spark.table(name).collect()
    # The row of 900 comes after its window has closed; the last windows are still open.
    assert sorted((r.run, r["mean"], r.n) for r in out["means"]) == [("a", 2.0, 2), ("b", 6.0, 2)]
    assert {r.run: r.id for r in out["ids"]}.keys() == {"a", "b", "c"} and {r.run: r.id for r in out["ids"]}["b"] == 3
