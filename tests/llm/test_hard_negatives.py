"""Hard negatives against brute force; the index's bounds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipyard.llm.hard_negatives import NormIndex, fill_windows, hard_negatives


def by_hand(rows, anchors, k=5):
    rows = [(i, label, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, label, v in rows if None not in (i, label, v) and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        scored = sorted((-int(v @ x), i, y) for i, y, x in rows if i != a and len(x) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:k]:
            inside = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(a, i, rank, j, -p, -n) for rank, (n, j, _) in enumerate(inside[:k], 1)]
    return sorted(out)


def got(df, ids, **more):
    found = hard_negatives(df, df.filter(F.col("vec_id").isin(ids)), **more)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


SCHEMA = "vec_id long, label int, embedding array<float>, score long, n int, `a.b` int"


@pytest.mark.parametrize("block,anchor_block,dim", [(16_384, 8_192, 64), (50, 7, 20), (64, 3, 3)])
def test_hard_negatives_are_brute_force(spark, block, anchor_block, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(12, dim))
    vectors = [(centres[rng.integers(12)] * (rng.random() < 0.6) + rng.normal(size=dim) * 0.3) for _ in range(500)]
    vectors[400:430] = [vectors[0]] * 30  # a group of copies: ties
    rows = [(i, int(rng.integers(4)) if i % 9 else 17, np.float32(v / np.linalg.norm(v)).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    anchors = list(range(0, 500, 10)) + [9, 405, 423]
    assert got(df, anchors, block=block, anchor_block=anchor_block) == by_hand(rows, set(anchors))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [0.5, 0.5]), (3, 2, [0.45, 0.1]), (4, 2, [0.5, -3.0]), (5, None, [1.0, 1.0]), (6, 2, None), (7, 2, [nan, 1.0]), (8, 1, [inf, 1.0]), (9, 1, []), (10, 1, [1.0, None]), (11, 1, [1.0, 0.0, 0.0]), (None, 1, [1.0, 0.0]), (12, 1, [-1.0, 0.0]), (13, 2, [0.0, 0.0]), (14, 2, [0.0, 5.0]), (15, 1, [0.0, 0.0]), (16, 3, [0.4, 0.0]), (16, 3, [0.4, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    anchors = [1, 5, 7, 9, 11, 12, 13, 15]
    assert got(df, anchors) == by_hand(rows, set(anchors))
    assert got(df.limit(0), anchors) == [] and got(df, [5]) == []
    twice = df.filter("vec_id IN (1, 2, 3)").unionByName(df.filter("vec_id = 1"))
    assert {r[0] for r in got(twice, [1])} == {1} and len(got(twice, [1])) == 1


def test_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    data = rng.integers(-(2**29), 2**29, (300, 10))
    index = NormIndex(data)
    ids, labels = np.arange(300), rng.integers(0, 2, 300)
    a = data[:40]
    low, high = np.full((40, 1), 2**52), np.full((40, 1), 2**62)
    parts = fill_windows(index, ids, labels, a, ids[:40], labels[:40], low, high, True, 3)
    found = sorted((int(i), int(ids[r]), int(s)) for x in parts for i, _, r, s in zip(*x, strict=True))
    want = []
    for i in range(40):
        best = sorted((-int(data[i] @ data[j]), j) for j in range(300) if j != i and labels[j] == labels[i] and data[i] @ data[j] >= 2**52)[:3]
        want += [(i, j, -s) for s, j in best]
    assert found == sorted(want) and want


def test_the_index_leaves_out_what_norms_cover():
    """At high thresholds most products are never made, and nothing is lost."""
    rng = np.random.default_rng(2)
    data = np.floor(256 * np.linalg.qr(rng.normal(size=(400, 64)))[0][:, :64] * np.sqrt(400 / 64)).astype(np.int64)
    data[:50] = data[0] + rng.integers(-2, 3, (50, 64))
    index, anchors = NormIndex(data), data[:20]
    scores = anchors @ data.T
    for share, most in ((0.95, 0.6), (0.5, 1.0), (-1.0, 1.0)):
        least = np.floor(share * np.sqrt((anchors**2).sum(axis=1)) * np.sqrt((data**2).sum(axis=1)).max()).astype(np.int64)
        a, r, s, work = index.join(anchors, least, np.ones((20, 400), bool))
        want = np.argwhere(scores >= least[:, None])
        assert sorted(zip(a.tolist(), r.tolist(), strict=True)) == sorted(map(tuple, want.tolist())) and (scores[a, r] == s).all()
        assert work <= most * 20 * 400 * 64
    r = random.Random(0)
    allowed = np.array([[r.random() < 0.5 for _ in range(400)] for _ in range(20)])
    a, r, _, _ = index.join(anchors, least, allowed)
    assert (np.bincount(a * 400 + r, minlength=8000).reshape(20, 400) == (allowed & (scores >= least[:, None]))).all()
