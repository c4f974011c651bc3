"""Word shingles as 64-bit hashes, bounded summaries of what repeats in a corpus, and connected components."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, discard, gives_back, staged

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; each seed gives another order of the same hashes."""
    with np.errstate(over="ignore"):
        x = h + _ODD[0] * np.uint64(2 * seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, kept while a worker runs, emptied at a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Lower-case A-Z; runs of anything but the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashed: np.ndarray, width: int = 5) -> np.ndarray:
    """The hash of each run of ``width`` words in order; with fewer words, of the whole sequence; nothing of nothing."""
    n = len(hashed)
    if n == 0:
        return hashed
    k = min(n, width)
    with np.errstate(over="ignore"):
        out = np.full(n - k + 1, np.uint64(k))
        for i in range(k):
            out = (out ^ hashed[i : n - k + 1 + i]) * _ODD[i % 6]
            out ^= out >> np.uint64(29)
        return mix(out)


def shingle_arrays(words: list[list[bytes]], known: WordHashes, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, their bounds, word hashes, their bounds) of many texts, one after the other; as ``shingle_hashes`` of each."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    hashed = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(words)), np.uint64, int(n.sum()))
    ends = np.concatenate(([0], np.cumsum(n)))
    return *_shingles(hashed, ends, width), hashed, ends


def _shingles(hashed: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, their bounds) of texts whose word hashes lie between ``ends``."""
    n = np.diff(ends)
    sizes = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(bounds[-1], np.uint64)
    if len(hashed) >= width:
        whole = shingle_hashes(hashed, width)  # those across two texts are left out
        at = np.repeat(ends[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
        out = whole[np.minimum(at, len(whole) - 1)]
    for i in np.flatnonzero((n > 0) & (n < width)):
        out[bounds[i]] = shingle_hashes(hashed[ends[i] : ends[i + 1]], width)[0]
    return out, bounds


class TextShingles:
    """Shingles of whole Arrow columns of texts, without a Python object a word.

    A word's hash is a polynomial of its bytes' values (64 random bits each; A-Z as a-z), modulo 2^64 and mixed: words that
    differ in one byte never share it, others by chance.
    """

    _BASE = 0x9E3779B97F4A7C13  # odd, and 3 modulo 8, so that swapped bytes keep 63 bits
    SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))

    def __init__(self, width: int):
        self.width = width
        byte = np.arange(256, dtype=np.uint64)
        byte[65:91] += np.uint64(32)
        self.value = np.where(self.SPACE, np.uint64(0), mix(byte, 7))
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            with np.errstate(over="ignore"):
                self.power, self.inverse = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)))) for x in (self._BASE, pow(self._BASE, -1, 1 << 64)))
        return self.power, self.inverse

    def parts(self, texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end, shingles, their bounds) of texts of about ``limit`` bytes in turn, one text at least; a null is empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(at, at[a] + limit, side="right")) - 1)
            yield a, b, *self._of(data[at[a] : at[b]], at[a : b + 1] - at[a])
            a = b

    def _of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = self.SPACE[data]
        new = ~space
        new[1:] &= space[:-1]
        inner = at[:-1][at[:-1] < len(data)]
        new[inner] = ~space[inner]
        starts = np.flatnonzero(new)
        ends = np.searchsorted(starts, at)
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
        power, inverse = self._powers(len(data))
        with np.errstate(over="ignore"):
            x = self.value[data]
            x *= power[: len(data)]
            hashed = mix(np.add.reduceat(x, starts) * inverse[starts])
        return _shingles(hashed, ends, self.width)


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(h) < 2:
        return h
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


# What repeats. Hashes go to buckets by their first bits, four bytes each, and every bucket counts its own.


def bucket_bits(total_bytes: int) -> int:
    """log2 of the number of buckets: a bucket gets the hashes of about 16 MB of text."""
    return max(6, min(24, math.ceil(math.log2(max(1, total_bytes / 16e6)))))


def to_planes(v: np.ndarray) -> bytes:
    """Sorted four-byte values as differences, byte by byte place, which the shuffle's compression halves."""
    return np.diff(v, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(d, dtype=np.uint32)


def packed_counts(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Hashes as one row a bucket: distinct four-byte values, and place and count of those that occur more than once."""
    h = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]))
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    n, h = np.diff(np.append(first, len(h))), h[first]
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    value = (h >> np.uint64(32 - bits)).astype(np.uint32)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(h) else np.zeros(0, np.int64)
    data, more = [], []
    for a, b in zip(starts, np.append(starts, len(h))[1:], strict=True):
        data.append(to_planes(value[a:b]))
        at = np.flatnonzero(n[a:b] > 1)
        more.append(np.concatenate((at, n[a:b][at])).astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int64()), pa.array(data, pa.binary()), pa.array(more, pa.binary())], names=["bucket", "data", "more"])


PACKED = "bucket long, data binary, more binary"


def _repeated(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    parts, counts = [], []
    for data, more in zip(rows.column("data").to_pylist(), rows.column("more").to_pylist(), strict=True):
        parts.append(from_planes(data))
        n = np.ones(len(parts[-1]), np.int64)
        at, times = np.frombuffer(more, "<u4").reshape(2, -1)
        n[at] = times
        counts.append(n)
    v, n = np.concatenate(parts), np.concatenate(counts)
    order = np.argsort(v, kind="stable")
    v, n = v[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    n = np.add.reduceat(n, first)
    on = n > 1
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([int(on.sum())], pa.int64()), "vals": pa.array([v[first][on].tobytes()], pa.binary()), "counts": pa.array([np.minimum(n[on], (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())})


def places(value: np.ndarray, log2: int) -> list[np.ndarray]:
    """Four bits of a bucket's 2^log2 for each four-byte value."""
    with np.errstate(over="ignore"):
        return [((value * np.uint32(m)) >> np.uint32(32 - log2)).astype(np.int64) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


class Repeats:
    """What tasks know of the hashes that occur twice or more: a bitmap and the most frequent ones.

    The bitmap is a Bloom filter without false negatives, so what it lacks occurs once; it has 16 bits a repeated hash,
    ``most_bits`` at most, and says yes too often beyond that, which costs work but no result. ``heavy``: at most a million hashes
    with their counts, only used to order hashes.
    """

    def __init__(self, bits: int, log2: int, maps: dict[int, np.ndarray], heavy: np.ndarray, counts: np.ndarray):
        self.bits, self.log2 = bits, log2
        size = (1 << log2) // 8
        self.bitmap = np.zeros((1 << bits) * size, np.uint8)
        for b, m in maps.items():
            self.bitmap[b * size : (b + 1) * size] = m
        order = np.argsort(heavy)
        self.heavy, self.counts = heavy[order], counts[order]

    def seen_twice(self, h: np.ndarray) -> np.ndarray:
        yes = np.zeros(len(h), bool)
        first = ((h >> np.uint64(64 - self.bits)) << np.uint64(self.log2)).astype(np.int64)
        value, on = (h >> np.uint64(32 - self.bits)).astype(np.uint32), np.arange(len(h))
        for place in places(value, self.log2):
            at = first[on] + place[on]
            on = on[(self.bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        yes[on] = True
        return yes

    def weight(self, h: np.ndarray) -> np.ndarray:
        """The count where it is known to be large, else 0."""
        if not len(self.heavy):
            return np.zeros(len(h), np.uint32)
        key = h >> np.uint64(32 - self.bits)
        at = np.minimum(np.searchsorted(self.heavy, key), len(self.heavy) - 1)
        return np.where(self.heavy[at] == key, self.counts[at], 0)


def repeats(packed: DataFrame, bits: int, name: str, most_bits: int = 1 << 29, most_heavy: int = 1 << 20, least_heavy: int = 3) -> Repeats:
    """Count every hash of ``packed`` rows in its bucket and gather the bounded summary."""
    shared = staged(packed.groupBy("bucket").applyInArrow(_repeated, "bucket long, n long, vals binary, counts binary"), name)
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    log2 = max(3, math.ceil(math.log2(max(1, min(most_bits, 16 * total)))) - bits)

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, hist = [], []
            for vals, counts in zip(batch.column("vals").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                bit = np.zeros(1 << log2, bool)
                for place in places(np.frombuffer(vals, np.uint32), log2):
                    bit[place] = True
                out.append(np.packbits(bit, bitorder="little").tobytes())
                c = np.frombuffer(counts, np.uint32)
                hist.append(np.bincount((np.log2(c[c >= least_heavy]) * 8).astype(int), minlength=260).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(out, pa.binary()), pa.array(hist, pa.list_(pa.int64()))], names=["bucket", "map", "hist"])

    got = shared.mapInArrow(maps, "bucket long, map binary, hist array<long>").collect()  # most_bits / 8 bytes at most
    hist = np.sum([r["hist"] for r in got], axis=0) if got else np.zeros(260, int)
    above = np.cumsum(hist[::-1])[::-1]
    cut = int(np.argmax(above <= most_heavy))

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ns = [], []
            for b, vals, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "vals", "counts")), strict=True):
                v, c = np.frombuffer(vals, np.uint32), np.frombuffer(counts, np.uint32)
                on = (c >= least_heavy) & ((np.log2(c) * 8).astype(int) >= cut)
                keys.append(((np.uint64(b) << np.uint64(32)) | v[on].astype(np.uint64)).tobytes())
                ns.append(c[on].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ns, pa.binary())], names=["keys", "ns"])

    top = shared.mapInArrow(heavy, "keys binary, ns binary").collect()  # most_heavy hashes at most
    keys = np.frombuffer(b"".join(r["keys"] for r in top), np.uint64)
    ns = np.frombuffer(b"".join(r["ns"] for r in top), np.uint32)
    discard(shared)
    return Repeats(bits, log2, {r["bucket"]: np.frombuffer(r["map"], np.uint8) for r in got}, keys, ns)


def word_shingles(width: int) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Shingles as ``shingle_arrays`` has them, of a column's texts."""
    known = WordHashes()

    def run(column: pa.Array) -> Iterator[np.ndarray]:
        texts = [t or "" for t in column.to_pylist()]
        for a, b in chunks_by_bytes(texts, 2_000_000):
            yield shingle_arrays([words_of(t) for t in texts[a:b]], known, width)[0]

    return run


def text_shingles(width: int) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Shingles as ``TextShingles`` has them, of a column's texts."""
    hashes = TextShingles(width)
    return lambda column: (flat for _, _, flat, _ in hashes.parts(column))


def repeated_shingles(docs: DataFrame, width: int, text: str, name: str, flush: int = 2_000_000, hashes: Callable = word_shingles) -> Repeats:
    """Which ``width``-word shingles, as ``hashes`` has them, stand at two places or more, over every text.

    Each task counts before it sends, so a shingle of every text is one value a task and ``flush`` hashes.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    bits = bucket_bits(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, n = hashes(width), [], 0
        for batch in batches:
            for flat in shingles(batch.column(0)):
                held.append(flat)
                n += len(held[-1])
                if n > flush:
                    yield packed_counts(held, bits)
                    held, n = [], 0
        yield packed_counts(held, bits)

    return repeats(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(gives_back(run), PACKED), bits, name)


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """node, label (its component's smallest node) of every node in ``edges`` (u, v: longs).

    Alternating large-star and small-star rounds, each written to the shared folder; a round groups and joins on the
    node, so a hub's edges can be split over tasks. Ends when a round changes no edge.
    """
    e = staged(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(e)
    while before[0]:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        old, e = e, staged(pair.select("e.u", "e.v").filter("u > v").distinct(), name)
        discard(old)
        if (now := mark(e)) == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select("v", "v").distinct())
