"""Language-model scoring by subword lattice likelihood, beside an add-one word unigram.

The vocabulary and its scores exist already: they are the prior of a unigram model over pieces. Expectation steps over
all segmentations of the training words, each as often as it occurs, make piece probabilities of them. A text's marginal
is the sum over all its segmentations, by a forward recursion in log space, times the end's probability. No piece
crosses a word start, so it is the product over the words, and each distinct word is summed once a worker.

Word counts are a table, not a dictionary. A bounded number of the most frequent words goes to the workers; what
remains in each document is joined with the table, so nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, chunks_by_bytes, gives_back, heaviest, staged
from .lattice import SPACE, expected_counts, load_pieces, log_marginals

LN10 = math.log(10)


def _words(text: str | None) -> list[bytes]:
    """Lower-case A-Z, then runs of anything but the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for t in batch.column(0).to_pylist():
            held.update(_words(t))
        if len(held) > 400_000:
            yield out()
            held = Counter()
    yield out()


def _piece_counts(model: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, logp = load_pieces(model), shared.value
        total = np.zeros(v.size)
        for batch in batches:
            total += expected_counts(v, [SPACE + w for w in batch.column(0).to_pylist()], batch.column(1).to_numpy().astype(float), logp)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["piece", "n"])

    return gives_back(run)


def _probabilities(v, counts: np.ndarray, ends: int, strength: float) -> np.ndarray:
    """Natural logs of piece probabilities: counts and ``strength`` times the vocabulary's own scores; ``ends`` and one share the mass."""
    usable = np.zeros(v.size, bool)
    usable[list(v.ids.values())] = True
    usable[v.byte_ids if v.byte_ids is not None else 0] = True
    prior = np.where(usable, np.exp(v.scores), 0)
    mass = counts + strength * prior / prior.sum()
    with np.errstate(divide="ignore"):
        return np.log(mass / (mass.sum() + ends + 1))


def _score(model: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, v = shared.value, load_pieces(model)
        common, logp = s["common"], s["logp"].reshape(-1, 1)
        part, row = TaskContext.get().partitionId(), 0

        def look(words: list[bytes]):
            lattice = log_marginals(v, [SPACE + w.decode("utf-8", "surrogatepass") for w in words], logp)[:, 0].tolist()
            for w, x in zip(words, lattice, strict=True):
                c = common.get(w)
                yield x, None if c is None else math.log10(c + 1)

        memo = Memo(look)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            rid, n, known, base, score, rare, rare_n = [], [], [], [], [], [], []
            for a, b in chunks_by_bytes([t or "" for t in texts]):
                words = [_words(t) for t in texts[a:b]]
                memo.fill(words)
                for w in words:
                    got = list(map(memo.__getitem__, w))
                    own = Counter(x for x, g in zip(w, got, strict=True) if g[1] is None)
                    rid.append((part << 33) + row)
                    row += 1
                    n.append(len(w) + 1)
                    known.append(len(w) - own.total())
                    base.append(sum(g[1] for g in got if g[1] is not None))
                    score.append(math.fsum(g[0] for g in got) / LN10)
                    rare.append([x.decode("utf-8", "surrogatepass") for x in own])
                    rare_n.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.int64()), batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array(rare, pa.list_(pa.string())), pa.array(rare_n, pa.list_(pa.int64()))],
                names=["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "rare_n"],
            )

    return gives_back(run)


def lm_scores(docs: DataFrame, held_out: Column, model: str, text: str = "text", doc_id: str = "doc_id", em_rounds: int = 2, strength: float = 1000.0, common_words: int = 1 << 18) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns where not ``held_out``.

    Null and empty texts are the end alone. Ids may be null or repeat, each row is scored for itself; extra columns
    are left out. Without training rows, nothing is known and the prior alone scores. An empty table gives an
    empty one. Words of any length train and score by all their segmentations. ``strength``: how many pieces the
    vocabulary's own scores count for.
    """
    spark = docs.sparkSession
    three = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    train = three.filter(~F.col("held_out"))
    words = staged(train.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    ends = train.count()
    got = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, distinct = got["n"] + ends, got["v"] + (ends > 0)
    v = load_pieces(model)
    counts = np.zeros(v.size)
    logp = _probabilities(v, counts, ends, strength)
    for _ in range(em_rounds):
        rows = words.mapInArrow(_piece_counts(model, spark.sparkContext.broadcast(logp)), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()  # one row a piece
        counts = np.zeros(v.size)
        counts[rows["piece"].to_numpy(int)] = rows["n"].to_numpy(float)
        logp = _probabilities(v, counts, ends, strength)
    end_score = math.log10((ends + 1) / (counts.sum() + strength + ends + 1))
    top = heaviest(words, "n", common_words).toPandas()
    held = {"common": {w.encode(): int(n) for w, n in zip(top["word"], top["n"], strict=True)}, "logp": logp}
    rows = staged(three.mapInArrow(_score(model, spark.sparkContext.broadcast(held)), "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<string>, rare_n array<long>"), "lm-rows")
    x = rows.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
    rare = x.select("rid", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("k"))
    k, c = F.col("k"), F.coalesce("n", F.lit(0))
    looked = rare.join(words, "word", "left").groupBy("rid").agg(F.sum(F.when(c > 0, k).otherwise(0)).alias("more"), F.sum(k * F.log10(c + 1)).alias("add"))
    end_known, end_base = (1, math.log10(ends + 1)) if ends else (0, 0.0)
    tokens = F.col("n_tokens")
    return rows.select("rid", "doc_id", "held_out", "n_tokens", "known", "base", "score").join(looked, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(end_known)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("add", F.lit(0.0)) + F.lit(end_base) - tokens * F.lit(math.log10(n_all + distinct + 1))).alias("base_score"),
        (F.col("score") + F.lit(end_score)).alias("score"),
    )
