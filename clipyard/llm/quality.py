"""Quality classifier: a generalised additive model with pairwise interactions.

Text features come from one Arrow pass over whole texts. The model is fitted on a bounded sample of labelled rows
by cyclic boosting: in each round every feature in turn gets a shallow tree on its bins, which adds to that
feature's lookup table; then the pairs with the largest remaining interaction get small trees on two features. A
score is the sum of looked-up values, so scoring is vectorised additions over bins.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

FEATURES = ["log_bytes", "log_words", "word_len", "distinct", "top_word", "adjacent", "pairs", "upper", "digits", "bang", "marks", "lines", "line_repeat", "line_len", "non_ascii", "short_words", "long_words", "squeeze", "braces", "ends"]
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_HIGH = bytes(range(128, 256))


def text_features(text: str | None) -> list[float]:
    """The features of one text; all are finite and 0 where a ratio has nothing under it."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    words = raw.split()
    w = len(words)
    if not w:
        return [float(np.log1p(n)), *[0.0] * (len(FEATURES) - 1)]
    count = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    sizes = [*map(len, words)]
    less = lambda drop: (n - len(raw.translate(None, drop))) / n
    return [
        float(np.log1p(n)), float(np.log1p(w)), sum(sizes) / w, len(count) / w, max(count.values()) / w,
        sum(a == b for a, b in itertools.pairwise(words)) / w, len(set(itertools.pairwise(words))) / w,
        less(_UPPER), less(_DIGITS), raw.count(b"!") / w, less(_MARKS), len(lines) / w, 1 - len(set(lines)) / len(lines), w / len(lines),
        less(_HIGH), sum(s <= 2 for s in sizes) / w, sum(s > 12 for s in sizes) / w, len(zlib.compress(raw, 1)) / n, less(b"{}<>[]|\\"),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
    ]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([text_features(t) for t in batch.column(1).to_pylist()], float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x[:, i]) for i in range(len(FEATURES))]], names=["doc_id", *FEATURES])


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        z = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Newton steps of a shallow tree over ordered bins, grown best split first."""
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = (1e-9, None)
        for a, b in spans:
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            value = np.where((ch[at] - ch[a] >= least) & (ch[b] - ch[at] >= least), gain(a, at) + gain(at, b) - gain(a, b), 0)
            if value.max() > best[0]:
                best = (value.max(), (a, int(at[value.argmax()]), b))
        if best[1] is None:
            break
        a, m, b = best[1]
        spans.remove((a, b))
        spans += [(a, m), (m, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """The best two-level tree on a grid: one cut of the first feature, one of the second on each side."""
    best, out = 1e-9, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for swap in (False, True):
        gg, hh = (g.T, h.T) if swap else (g, h)
        for m in range(1, gg.shape[0]):
            table, total = np.zeros_like(gg), 0.0
            for side in (slice(0, m), slice(m, None)):
                sg, sh = gg[side].sum(axis=0), hh[side].sum(axis=0)
                t = _tree(sg, sh, 2, least)
                table[side] = t[None, :]
                total += (t * sg).sum()
            if total - whole > best:
                best, out = total - whole, table.T if swap else table
    return out, best


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 4, bins: int = 48, pair_bins: int = 8, rate: float = 0.15, leaves: int = 4, least: float = 4.0) -> AdditiveModel:
    """Cyclic boosting of the log-odds; the constant base rate if there is one class or no row."""
    rate0 = (y.sum() + 1) / (len(y) + 2)
    f = x.shape[1]
    cut = lambda n: [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(f)]
    edges, pair_edges = cut(bins), cut(pair_bins)
    m = AdditiveModel(edges, float(np.log(rate0 / (1 - rate0))), [np.zeros(len(e) + 1) for e in edges], [], pair_edges)
    if len(y) == 0 or y.min() == y.max():
        return m
    b = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    z = np.full(len(y), m.intercept)
    for _ in range(rounds):
        for j in range(f):
            p = 1 / (1 + np.exp(-z))
            n = len(m.tables[j])
            step = rate * _tree(np.bincount(b[j], y - p, n), np.bincount(b[j], p * (1 - p), n), leaves, least)
            m.tables[j] += step
            z += step[b[j]]
    pb = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p, shape = 1 / (1 + np.exp(-z)), (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
        at = pb[i] * shape[1] + pb[j]
        return np.bincount(at, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((-_pair_tree(*grid(i, j), least)[1], i, j) for i in range(f) for j in range(i + 1, f)))
    m.pairs = [(i, j) for _, i, j in ranked[:n_pairs]]
    m.pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in m.pairs]
    for _ in range(pair_rounds):
        for t, (i, j) in zip(m.pair_tables, m.pairs, strict=True):
            step = rate * _pair_tree(*grid(i, j), least)[0]
            t += step
            z += step[pb[i], pb[j]]
    return m


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", label: str = "quality", threshold: float = 0.7, sample: int = 40_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learns from labelled rows that aren't ``held_out``.

    ``sample``: the fit takes about this many labelled rows, those of least hash of the id, fewer if there are
    fewer. Null texts count as empty and get a score. Rows whose label or id is null teach nothing; a repeated
    label row counts by its largest label; rows that repeat an id are scored each for itself, whole texts however long.
    Equal features give equal scores. Without labels every score is 0.5. Extra columns are left out; an empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    two = docs.select(F.struct(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out")).alias("key"), F.col(text).cast("string").alias("text"))
    kind = two.schema["key"].dataType.simpleString()
    rows = staged(two.mapInArrow(_features, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)), "quality-features")
    y = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    known = y.join(rows.filter(~F.col("doc_id.held_out")).withColumn("id", F.col("doc_id.doc_id")), "id")
    n = known.count()
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    got = known.filter(place < F.lit(min(1.0, sample / max(n, 1)) * (1 << 30))).select("id", "y", *FEATURES).limit(2 * sample).toPandas().sort_values("id", kind="stable")
    model = spark.sparkContext.broadcast(fit_additive(got[FEATURES].to_numpy(float), got["y"].to_numpy(float)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy() for f in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(x))], names=["key", "score"])

    out = rows.select(F.col("doc_id").alias("key"), *FEATURES).mapInArrow(score, f"key {kind}, score double")
    return out.select("key.doc_id", "key.held_out", "score", (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))
