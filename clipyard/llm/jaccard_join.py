"""N-gram Jaccard self-join by multiple-global-order prefix filtering.

If two sets have a Jaccard similarity of t, then under any one order of all tokens they share a token among each
set's first n - ceil(t n) + 1. Several orders give several such conditions, and a linked pair meets all of them:

1. Count every shingle of the corpus in buckets; tasks get a bounded summary (which repeat, which are frequent).
   Only repeated shingles can be shared, so a text goes on with those alone, and only if they are enough for a link.
2. Each order sorts a text's shingles by (frequency class, a hash of its own): single ones first, frequent ones last.
3. Texts that share a prefix token under the first order are candidate pairs: all pairs of a token of few texts; of
   hotter tokens, the text with the largest repeated part with all others. A pair stays if sizes allow a link and
   the two also share a prefix token under every other order; then their sets are compared.
4. A hot token whose texts these links bring into one component is settled. What is left meets all texts of its
   hot tokens in blocks of bounded size through an inverted index, so no list of all pairs is ever made.

Copies share a 64-bit id of their word sequence from the start and enter once (two different sequences share an id
with a chance of 3e-20 a pair). Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, discard, gives_back, staged
from .shingles import WordHashes, connected_components, distinct, mix, repeated_shingles, shingle_arrays, words_of

#: All pairs of a token are candidates up to so many texts.
FEW = 16
#: A block of what is left holds about so many texts and shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 2000, 1_000_000


def prefix_length(n: int, percent: int) -> int:
    """First tokens of which a linked pair shares one: n - ceil(percent n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def prefixes(own: np.ndarray, single: int, weight: np.ndarray, orders: int, percent: int) -> list[np.ndarray]:
    """The repeated tokens ``own`` among a set's first ones, under each order; ``single`` more tokens occur once and come first."""
    p = prefix_length(len(own) + single, percent) - single
    cls = np.where(weight > 0, (2 * np.log2(np.maximum(weight, 1))).astype(np.uint64), np.uint64(0))
    out = []
    for k in range(orders):
        rank = (cls << np.uint64(57)) | (mix(own, k) >> np.uint64(7))
        out.append(own[np.argpartition(rank, p - 1)[:p]] if p < len(own) else own)
    return out


ROWS = "row long, uid long, n long, shingles binary, tokens array<array<long>>"


def _rows(shared, orders: int, width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, known = shared.value, WordHashes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks_by_bytes(texts, 2_000_000):
                flat, bounds, hashed, ends = shingle_arrays([words_of(t) for t in texts[a:b]], known, width)
                twice = rep.seen_twice(flat)
                uids, sizes, sets, tokens = [], [], [], []
                for i in range(b - a):
                    on, whole = twice[bounds[i] : bounds[i + 1]], flat[bounds[i] : bounds[i + 1]]
                    own = distinct(whole[on])
                    single = len(on) - int(np.count_nonzero(on))  # what isn't repeated stands at one place
                    n = len(own) + single
                    live = len(own) > 0 and 100 * len(own) >= percent * n
                    uids.append(xxhash.xxh3_64_intdigest(hashed[ends[i] : ends[i + 1]].tobytes()) - (1 << 63))
                    sizes.append(n)
                    sets.append(own.tobytes() if live else None)
                    tokens.append([x.view(np.int64) for x in prefixes(own, single, rep.weight(own), orders, percent)] if live else None)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(uids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(tokens, pa.list_(pa.list_(pa.int64()))), *[c.slice(a, b - a) for c in batch.columns[2:]]], names=["row", "uid", "n", "shingles", "tokens", *batch.schema.names[2:]])

    return gives_back(run)


class Roots:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


class Index:
    """Inverted index of some sets: how many elements each shares with a given one."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = [len(s) for s in sets]
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
        order = np.argsort(flat, kind="stable")
        flat, self.owner, self.count = flat[order], owner[order], len(sets)
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        self.values, self.first = flat[first], np.append(first, len(flat))

    def shared(self, own: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        a, n = self.first[at], self.first[at + 1] - self.first[at]
        where = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.owner[where], minlength=self.count)


def linked(both, n, m, percent: int):
    """Whether sets of ``n`` and ``m`` tokens that share ``both`` are similar enough."""
    return 100 * both >= percent * (n + m - both)


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, n, m in zip(*(batch.column(c).to_pylist() for c in ("shingles", "v_shingles", "n", "v_n")), strict=True):
                both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                keep.append(linked(both, n, m, percent))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _blocks(percent: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        u, v = [], []
        if left.num_rows and right.num_rows:
            ids, sizes, labels = (left.column(c).to_numpy() for c in ("uid", "n", "label"))
            index, at = Index([np.frombuffer(x, np.uint64) for x in left.column("shingles").to_pylist()]), {}
            names, where = np.unique(np.concatenate((labels, right.column("label").to_numpy())), return_inverse=True)
            roots = Roots(len(names))
            for i, (uid, n, s) in enumerate(zip(*(right.column(c).to_pylist() for c in ("uid", "n", "shingles")), strict=True)):
                both = index.shared(np.frombuffer(s, np.uint64))
                for x in np.flatnonzero((both > 0) & linked(both, sizes, n, percent)).tolist():
                    if roots.join(int(where[x]), int(where[len(ids) + i])):  # one link a pair of components is enough
                        u.append(uid)
                        v.append(int(ids[x]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """(u, v), u < v: all pairs of a token's few texts; its leader with each of many; sizes allow a link."""
    fits = lambda a, b: 100 * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)
    few = met.filter(F.col("m") <= FEW).groupBy("token").agg(F.array_sort(F.collect_list(F.struct("uid", "n"))).alias("all"))
    pair = lambda x, i: F.transform(F.filter(F.slice("all", F.lit(1), i), lambda y: fits(x["n"], y["n"])), lambda y: F.struct(y["uid"].alias("u"), x["uid"].alias("v")))
    pairs = few.select(F.explode(F.flatten(F.transform("all", pair))).alias("p")).select("p.u", "p.v")
    hot = met.filter((F.col("m") > FEW) & (F.col("uid") != F.col("lead.uid")) & fits(F.col("n"), F.col("lead.n")))
    return pairs.union(hot.select(F.least("uid", "lead.uid"), F.greatest("uid", "lead.uid"))).distinct()


def _rest(open_: DataFrame, texts: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between the texts of open hot tokens: those outside a cell's largest component against the whole cell, in blocks."""
    lists = open_.groupBy("token").agg(F.min("uid").alias("a"))
    edges = open_.join(lists, "token").filter("uid <> a").select(F.col("uid").alias("u"), F.col("a").alias("v"))
    cells = connected_components(edges, "join-cells").select(F.col("node").alias("uid"), F.col("label").alias("cell"))
    members = cells.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    members = staged(members.join(texts.select("uid", "n", "shingles").hint("merge"), "uid"), "join-members")
    weight = F.octet_length("shingles") / 8
    parts = members.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("docs"), F.sum(weight).alias("total"))
    top = parts.groupBy("cell").agg(F.max_by("label", F.struct("docs", "label")).alias("top"), F.sum("docs").alias("docs"), F.sum("total").alias("total"), F.max(F.struct("docs", "label", "total")).alias("big"))
    blocks = lambda docs, n: F.greatest(F.lit(1), F.ceil(docs / F.lit(BLOCK_DOCS)), F.ceil(n / F.lit(BLOCK_SHINGLES))).cast("int")
    cut = top.select("cell", "top", blocks(F.col("docs"), F.col("total")).alias("lb"), blocks(F.col("docs") - F.col("big.docs"), F.col("total") - F.col("big.total")).alias("rb"))
    placed = members.join(cut, "cell")
    place = lambda of: F.pmod(F.xxhash64("uid"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = placed.select("cell", place("lb").alias("a"), every("rb").alias("b"), "uid", "n", "label", "shingles")
    right = placed.filter("label <> top").select("cell", every("lb").alias("a"), place("rb").alias("b"), "uid", "n", "label", "shingles")
    key, right = ["cell", "a", "b"], right.toDF(*right.columns)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_blocks(percent), "u long, v long")


def jaccard_components(docs: DataFrame, percent: int = 75, width: int = 5, orders: int = 3, text: str = "text", doc_id: str = "doc_id", row_key: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links of at least ``percent`` reach.

    Links are between sets of ``width``-word shingles (with fewer words, the whole sequence). Null, empty and blank
    texts have no shingle and link with nothing. Rows that repeat an id take part each with its own text; null ids
    take part, but a component's id is null only if all its ids are. Extra columns are left out; an empty table
    gives an empty one. With ``row_key``, a long that tells rows apart, also row_key and kept: whether the row is its
    component's first by id, null ids last, then by key.
    """
    spark, extra = docs.sparkSession, [] if row_key is None else ["key"]
    two = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).cast("string").alias("text"), *([F.col(row_key).cast("long").alias("key")] if extra else []))
    shared = spark.sparkContext.broadcast(repeated_shingles(two, width, "text", "join-repeats"))
    rows = staged(two.mapInArrow(_rows(shared, orders, width, percent), ROWS + (", key long" if extra else "")), "join-rows")
    texts = staged(rows.filter("tokens IS NOT NULL").select("uid", "n", "shingles", "tokens").dropDuplicates(["uid"]), "join-texts")
    token = texts.select("uid", "n", (F.octet_length("shingles") / F.col("n")).alias("part"), F.explode(F.col("tokens")[0]).alias("token"))
    lists = token.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.max(F.struct("part", (-F.col("uid")).alias("no"), "uid", "n")).alias("lead")).filter("m > 1")
    met = staged(token.select("token", "uid", "n").join(lists.select("token", "m", F.struct("lead.uid", "lead.n").alias("lead")).hint("merge"), "token"), "join-met")
    side = texts.select("uid", "n", "shingles", F.slice("tokens", 2, max(1, orders - 1)).alias("tokens"))
    pairs = _candidates(met, percent).join(side.hint("merge"), F.col("u") == F.col("uid")).select("v", "uid", "n", "shingles", "tokens")
    pairs = pairs.join(side.select(F.col("uid").alias("v"), F.col("n").alias("v_n"), F.col("shingles").alias("v_shingles"), F.col("tokens").alias("v_tokens")).hint("merge"), "v")
    for k in range(orders - 1):
        pairs = pairs.filter(F.arrays_overlap(F.col("tokens")[k], F.col("v_tokens")[k]))
    links = staged(pairs.select("uid", "v", "n", "v_n", "shingles", "v_shingles").mapInArrow(_compare(percent), "u long, v long"), "join-links")
    labels = staged(connected_components(links, "join-first").filter("node <> label"), "join-labels")
    hot = met.filter(F.col("m") > FEW).select("token", "uid").join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    unsettled = hot.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    open_ = staged(hot.select("token", "uid").join(unsettled.hint("merge"), "token", "left_semi"), "join-open")
    if not open_.isEmpty():
        more = staged(_rest(open_, texts, labels, percent), "join-more")
        joined = connected_components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).union(more), "join-last")
        old, labels = labels, staged(joined.filter("node <> label"), "join-labels")
        discard(old, more)
    discard(texts, met, links, open_)
    named = rows.select("row", "uid", "n", *extra).join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    named = staged(named.select("row", "n", "label", *extra), "join-named")
    discard(rows, labels)
    place = F.struct(F.col("row").isNull(), "row", *extra)
    least = named.filter("n > 0").groupBy("label").agg(F.min("row").alias("least"), *([F.min(place).alias("first")] if extra else []))
    out = named.join(least, "label", "left")
    return out.select(F.col("row").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("row")).alias("component_id"), *([F.col("key").alias("row_key"), F.when(F.col("n") > 0, place.eqNullSafe(F.col("first"))).otherwise(F.lit(True)).alias("kept")] if extra else []))
