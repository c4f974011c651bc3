"""Best-fit packing of token pieces into sequences, on vectors of (tokens, documents, attention cost).

The choice needs only how many pieces there are of each length, a table of at most ``capacity`` rows: best-fit
decreasing runs on counts, over classes of bins that hold the same pieces, so the driver's work is bounded by the
number of lengths, not of documents. Each piece then finds its place from its rank among pieces of its length, by
a binary search in the plan. A piece's vector is (length, 1, length squared).
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, chunks_by_bytes, gives_back, space_units, staged
from .token_counts import encode_units

#: Units with other characters go to the tokenizers library itself: engines may class newer letters differently.
_LATIN = re.compile("[^\x00-ɏ]")


def plan(counts: dict[int, int], capacity: int, max_docs: int, max_cost: float, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), score: str = "norm") -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of bins, [(length, pieces of it in each bin)]) by vector best-fit decreasing on counts.

    Among bin classes with room in every dimension, ``score`` picks the one with the least weighted residual norm
    after the piece is in ("norm") or the largest weighted dot product of piece and residual ("dot"); ties go to
    the older class.
    """
    cap = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights, float)
    room, left, inside = np.zeros((0, 3)), np.zeros(0, np.int64), []

    def add(r: np.ndarray, n: int, held: list) -> None:
        nonlocal room, left
        room, left = np.vstack([room, r]), np.append(left, n)
        inside.append(held)

    for size in sorted(counts, reverse=True):
        n, item = counts[size], np.array([size, 1, float(size) ** 2])
        if (item > cap).any():
            raise ValueError(f"a piece of {size} tokens fits no bin")
        while n:
            fits = np.flatnonzero((left > 0) & (room >= item).all(axis=1))
            if len(fits):
                after = (room[fits] - item) / cap
                s = np.sqrt((w * after**2).sum(axis=1)) if score == "norm" else -((w * item / cap) * (room[fits] / cap)).sum(axis=1)
                c = int(fits[np.argmin(s)])
                r, held, bins = room[c], inside[c], int(left[c])
            else:
                c, r, held, bins = -1, cap, [], n
            each = int(np.floor(r / item).min())
            full, rest = min(bins, n // each), 0
            if full < bins and n - full * each:
                rest = n - full * each
            if c >= 0:
                left[c] -= full + (rest > 0)
            if full:
                add(r - each * item, full, [*held, (size, each)])
            if rest:
                add(r - rest * item, 1, [*held, (size, rest)])
            n -= full * each + rest
    return [(int(m), held) for m, held in zip(left, inside, strict=True) if m]


def places(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, pieces in each bin, first sequence id, first offset), by rank."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first = 0
    for n, held in bins:
        at = 0
        for size, each in held:
            r = ranks.get(size, 0)
            out.setdefault(size, []).append((r, each, first, at))
            ranks[size] = r + n * each
            at += size * each
        first += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


@functools.lru_cache(maxsize=2)
def _fast(ranks_path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def unit_ids(tokenizer: str, ranks: str | None, units: list[str]) -> list[bytes]:
    """Ids of each unit as little-endian uint32. ``ranks``: the same vocabulary as ranks, for a faster library with equal ids."""
    out: list = [None] * len(units)
    slow = range(len(units))
    if ranks:
        enc = _fast(ranks)
        slow = []
        for i, u in enumerate(units):
            if _LATIN.search(u):
                slow.append(i)
            else:
                out[i] = np.array(enc.encode_ordinary(u) if "<|" not in u else enc.encode(u, allowed_special="all"), "<u4").tobytes()
    for i, ids in zip(slow, encode_units(tokenizer, [units[i] for i in slow]), strict=True):
        out[i] = np.array(ids, "<u4").tobytes()
    return out


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"


def _pieces(tokenizer: str, ranks: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(lambda units: unit_ids(tokenizer, ranks, units))
        get, part = memo.__getitem__, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for a, b in chunks_by_bytes(texts):
                units = [space_units(t) for t in texts[a:b]]
                memo.fill(units)
                for doc, u in zip(ids[a:b], units, strict=True):
                    data = b"".join(map(get, u)) + b"\0\0\0\0"
                    n, start, piece = len(data) // 4, 0, 0
                    while start < n:
                        size = capacity if n - start >= capacity and (start or n % capacity == 0) else n % capacity
                        rows.append((doc, piece, start, size, zlib.crc32(data[4 * start : 4 * (start + size)]), part, seen[size]))
                        seen[size] += 1
                        start, piece = start + size, piece + 1
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])

    return gives_back(run)


def best_fit_pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 2048, max_docs: int | None = None, max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), score: str = "norm", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id 0, so null and empty texts are one token. Longer ones than
    ``capacity`` are cut from the end in full pieces; the first may be shorter. ``max_docs`` and ``max_cost`` (the
    sum of squared lengths) default to values that never bind. Rows that repeat an id are packed each for itself;
    null ids stay null; extra columns are left out; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    max_docs, max_cost = max_docs or capacity, max_cost or float(capacity) ** 2
    two = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = staged(two.mapInArrow(_pieces(tokenizer, ranks, capacity), PIECES), "pack-pieces")
    by_part = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hist = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    where = spark.sparkContext.broadcast(places(plan(hist, capacity, max_docs, max_cost, weights, score)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = where.value
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                t, mine = at[int(s)], np.flatnonzero(size == s)
                first, each, seq0, off0 = t[np.searchsorted(t[:, 0], rank[mine], side="right") - 1].T
                seq[mine], off[mine] = seq0 + (rank[mine] - first) // each, off0 + (rank[mine] - first) % each * s
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    ranked = rows.join(base.select("part", "length", "base"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
