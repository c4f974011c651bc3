"""Hard-negative mining by threshold joins with norm bounds, whose thresholds fall until every window is full.

Vectors are integers and stand in blocks. A block is indexed for a threshold: dimensions are in order of falling
energy, and a vector's last dimensions, as many as its suffix norm times the anchor's norm still covers below the
threshold, are left out of the index. Anchors go along the index's dimensions and accumulate partial scores; a pair
whose partial score and what the remaining norms allow are under the threshold is pruned, what is left is scored
exactly. A join at high thresholds comes first; only anchors whose windows it doesn't fill are joined again at lower
ones, the last of which leaves nothing out.

The same join gives an anchor's positives (its best rows of the same label, one window without an upper end) and the
negatives below each positive's score (rows of other labels, a window a positive).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, gives_back, staged
from .top_k import quantised, usable

#: Dimensions that a step along the index takes together, and anchors that go along it together.
STEP, TOGETHER = 8, 32
#: Above every score.
OPEN = (1 << 63) - 1


class NormIndex:
    """A block of vectors, dimensions by falling energy, with the norms of what remains from every step on."""

    def __init__(self, data: np.ndarray):
        self.n, self.dim = data.shape
        self.order = np.argsort(-(data.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.data = data[:, self.order].astype(np.float64)
        self.whole = data.astype(np.int64)
        self.starts = list(range(0, self.dim, STEP))
        self.rest = self.remaining(self.data)

    def remaining(self, rows: np.ndarray) -> np.ndarray:
        """Norm of each row from every step on; the last column is zero. A little too large rather than too small."""
        square = np.add.reduceat(rows**2, self.starts, axis=1)
        left = np.cumsum(square[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.append(left, np.zeros((len(rows), 1)), axis=1)) * (1 + 1e-9)

    def join(self, anchors: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(anchor, row, exact score) of all allowed pairs that score ``least`` of the anchor or more, and how many products were added along the index.

        ``allowed``: anchors x rows, the pairs that count.
        """
        q, low = anchors[:, self.order].astype(np.float64), least.astype(np.float64)
        rest = self.remaining(q)
        longest = rest[:, :1] * self.rest[:, 0].max(initial=0)
        slack = 1e-6 * (1 + np.abs(low[:, None])) + 1e-9 * longest
        # How many steps of a row are in the index: what its suffix can add from there on is under every anchor's threshold.
        bound = ((low - slack[:, 0]) / np.maximum(rest[:, 0], 1e-300)).min()
        steps = np.minimum((self.rest >= bound).sum(axis=1), len(self.starts))
        row = np.flatnonzero(allowed.any(axis=0) & (steps > 0))
        row = row[np.argsort(-steps[row], kind="stable")]
        steps, alive, acc, work, found = steps[row], allowed[:, row], np.zeros((len(q), len(row))), 0, []
        for c, start in enumerate([*self.starts, self.dim]):
            # Rows whose index ends here are scored, those of which a pair is alive; the others go on.
            cut = int(np.searchsorted(-steps, -c)) if start < self.dim else 0
            ends = cut + np.flatnonzero(alive[:, cut:].any(axis=0))
            a, r = np.nonzero(alive[:, ends])
            if longest.max(initial=0) < 2**52:  # sums of doubles are exact
                score = (acc[:, ends] + q[:, start:] @ self.data[row[ends], start:].T)[a, r].astype(np.int64)
            else:
                score = np.array([anchors[i].astype(np.int64) @ self.whole[j] for i, j in zip(a, row[ends[r]], strict=True)], np.int64)
            good = score >= least[a]
            found.append((a[good], row[ends[r[good]]], score[good]))
            alive, acc, row, steps = alive[:, :cut], acc[:, :cut], row[:cut], steps[:cut]
            if not len(row):
                break
            end = min(start + STEP, self.dim)
            acc = acc + q[:, start:end] @ self.data[row, start:end].T
            work += len(q) * len(row) * (end - start)
            alive = alive & (acc + rest[:, c + 1 : c + 2] * self.rest[row, c + 1] + slack >= low[:, None])
            keep = alive.any(axis=0)
            alive, acc, row, steps = alive[:, keep], acc[:, keep], row[keep], steps[keep]
        a, r, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return a, r, score, work


def fill_windows(index: NormIndex, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, window, row, score): of each window [low, high] of each anchor the block's k best rows, ties to the smaller id.

    ``low`` and ``high``: anchors x windows; a window whose low end is above its high end is closed. Rows have the anchor's label, or
    another one; a row of the anchor's id is none of its rows.
    """
    out = []
    least = np.where(low <= high, low, OPEN).min(axis=1)
    size = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))
    # Anchors of like thresholds go together; where rows of their label count, those of a label.
    order = np.lexsort((-(least / np.maximum(size, 1e-300)), anchor_labels if same else np.zeros(len(anchors))))
    order = order[least[order] < OPEN]
    for i in range(0, len(order), TOGETHER):
        own = order[i : i + TOGETHER]
        allowed = ((anchor_labels[own, None] == labels) == same) & (anchor_ids[own, None] != ids)
        a, r, score, _ = index.join(anchors[own], least[own], allowed)
        for w in range(low.shape[1]):
            inside = (score >= low[own[a], w]) & (score <= high[own[a], w]) & (low[own[a], w] <= high[own[a], w])
            b, s, t = a[inside], r[inside], score[inside]
            best = np.lexsort((ids[s], -t, b))
            b, s, t = b[best], s[best], t[best]
            keep = np.arange(len(b)) - np.searchsorted(b, b) < k
            out.append((own[b[keep]], np.full(int(keep.sum()), w), s[keep], t[keep]))
    return out


def _filled(k: int, same: bool):
    def matrix(batch: pa.RecordBatch, name: str, i: int, kind: type) -> np.ndarray:
        return np.frombuffer(batch.column(name)[i].as_buffer(), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index, ids, labels = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, block = batch.column("dim")[i].as_py(), batch.column("block")[i].as_py()
                if known != (dim, block):  # rows of a block come one after another: its index is built once
                    ids, labels = matrix(batch, "ids", i, np.int64), matrix(batch, "labels", i, np.int64)
                    index, known = NormIndex(matrix(batch, "data", i, np.int64).reshape(-1, dim)), (dim, block)
                own, own_labels = matrix(batch, "a_ids", i, np.int64), matrix(batch, "a_labels", i, np.int64)
                low, high = (matrix(batch, c, i, np.int64).reshape(len(own), -1) for c in ("a_low", "a_high"))
                anchors = matrix(batch, "a_data", i, np.int64).reshape(-1, dim)
                parts = fill_windows(index, ids, labels, anchors, own, own_labels, low, high, same, k)
                a, w, r, s = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own[a], w, ids[r], s)], names=["anchor_id", "window", "vec_id", "score"])

    return gives_back(run)


def _packed(columns: dict[str, str], lists: tuple[str, ...]):
    """A group's rows as one row of raw int64 columns."""

    def run(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {"dim": [table.column("dim")[0].as_py()], "block": [table.column("block")[0].as_py()]}
        for name, new in columns.items():
            col = table.column(name).combine_chunks()
            col = col.flatten() if name in lists else col
            out[new] = [np.ascontiguousarray(col.to_numpy(zero_copy_only=False), np.int64).tobytes()]
        return pa.table(out, schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in columns.values()]]))

    return run


def _blocks(rows: DataFrame, size: int, columns: dict[str, str], lists: tuple[str, ...]) -> DataFrame:
    """Blocks of about ``size`` rows of one dimension, dealt out by row number."""
    n = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("blocks"))
    cut = rows.join(n, "dim").withColumn("block", F.pmod(F.col("n"), F.col("blocks")))
    kinds = ", ".join(f"{c} binary" for c in columns.values())
    return cut.select("dim", "block", *columns).groupBy("dim", "block").applyInArrow(lambda t: _packed(columns, lists)(t), f"dim int, block long, {kinds}")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def window_join(blocks: DataFrame, anchors: DataFrame, levels: list, same: bool, k: int, anchor_block: int) -> DataFrame:
    """anchor_id, window (number), rank, vec_id, score: of each window the k best rows.

    ``anchors``: n, dim, id, label, v and ``windows``, structs (w, low, high, aim); ``levels``: functions of ``aim`` that give falling low
    ends, each no lower than ``low``, the last one ``low`` itself. Windows that a level fills are done: rows it didn't look
    at score less. The others are joined again at the next one.
    """
    windows = anchors.select("id", F.explode("windows").alias("x")).select("id", "x.*")
    done, tables = [], []
    for i, level in enumerate(levels):
        last = i == len(levels) - 1
        tried = windows.withColumn("at", F.col("low") if last else F.greatest("low", level(F.col("aim"))))
        sides = tried.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("w", "at", "high"))).alias("x"))  # an anchor's windows, k at most
        # Every window has its place, open or not: the windows of a block's anchors form a matrix.
        slot = lambda w, name, other: F.coalesce(F.get(F.filter("x", lambda y: y["w"] == w), F.lit(0))[name], F.lit(other))
        places = F.sequence(F.lit(0), F.lit(0 if same else k - 1))
        low, high = F.transform(places, lambda w: slot(w, "at", OPEN)), F.transform(places, lambda w: slot(w, "high", -OPEN))
        asked = anchors.drop("windows").join(sides, "id").select("n", "dim", "id", "label", "v", low.alias("low"), high.alias("high"))
        packs = _blocks(asked, anchor_block, {"id": "a_ids", "label": "a_labels", "v": "a_data", "low": "a_low", "high": "a_high"}, ("v", "low", "high"))
        counts = blocks.groupBy("dim").agg((F.max("block") + 1).alias("of"))
        copies = packs.drop("block").join(counts, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1))).drop("of")
        found = blocks.join(copies.hint("merge"), ["dim", "block"]).mapInArrow(_filled(k, same), "anchor_id long, window long, vec_id long, score long")
        got = staged(_best(found, ["anchor_id", "window"], k), "negatives-level")
        tables.append(got)
        if last:
            done.append(got)
            break
        full = got.groupBy("anchor_id", "window").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= k).drop("m")
        done.append(got.join(full, ["anchor_id", "window"], "left_semi"))
        windows = staged(windows.join(full.select(F.col("anchor_id").alias("id"), F.col("window").cast("int").alias("w")), ["id", "w"], "left_anti"), "negatives-open")
        tables.append(windows)
        if windows.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    result = staged(out.select("anchor_id", "window", "rank", "vec_id", "score"), "negatives-windows")
    discard(*tables)
    return result


def hard_negatives(vectors: DataFrame, anchors: DataFrame, k: int = 5, share: int = 80, scale: float = 256.0, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", block: int = 16_384, anchor_block: int = 8_192) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``k`` best other rows of the same label by integer inner product, ties to the smaller
    id (all, if fewer). For each, the ``k`` best rows of other labels whose score is at least ``share`` percent of the
    positive's and no more than it (all, if fewer); a positive without such a row gives none. Rows with a null id or
    label, a null or empty vector, or a null or non-finite component take no part, as anchors neither; vectors of another length than the
    anchor's are none of its rows. Rows of the anchor's id are none of its rows; other rows that repeat an id count each; of anchors that
    repeat an id the one of least label and vector stays. Extra columns are left out; an empty table gives an empty one.
    """

    def ints(df: DataFrame) -> DataFrame:
        two = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
        two = two.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
        return two.select("id", "label", quantised(F.col("v"), scale).alias("v"))

    rows = ints(vectors).withColumn("dim", F.size("v"))
    # Written once: a row keeps its number, whatever is computed again.
    rows = staged(rows.withColumn("n", F.monotonically_increasing_id()), "negatives-rows")
    asked = ints(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.*").withColumn("dim", F.size("v"))
    asked = staged(asked.withColumn("n", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = staged(_blocks(rows, block, {"id": "ids", "label": "labels", "v": "data"}, ("v",)), "negatives-blocks")
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    most = rows.groupBy("dim").agg(F.max(norm(F.col("v"))).alias("most"))

    window = lambda w, low, high, aim: F.struct(w.cast("int").alias("w"), low.cast("long").alias("low"), high.cast("long").alias("high"), aim.cast("double").alias("aim"))
    # No score is above the product of the norms: thresholds are shares of it.
    first = asked.join(most, "dim").withColumn("windows", F.array(window(F.lit(0), F.lit(-OPEN), F.lit(OPEN), norm(F.col("v")) * F.col("most"))))
    shares = [lambda aim: F.floor(aim * F.lit(0.9)), lambda aim: F.floor(aim * F.lit(0.4)), None]
    positives = window_join(blocks, first.drop("most"), shares, True, k, anchor_block)

    # Positives of equal scores share a window; below zero, there is none.
    floor = F.expr(f"(cast(score as decimal(20, 0)) * {share} + 99) div 100")
    scores = positives.filter("score >= 0").groupBy("anchor_id", "score").agg((F.min("rank") - 1).alias("w"))
    held = scores.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(window(F.col("w"), floor, F.col("score"), F.col("score"))).alias("windows"))  # k at most
    negatives = window_join(blocks, asked.join(held, "id"), [lambda aim: F.floor(aim * F.lit(0.97)), None], False, k, anchor_block)
    discard(rows, asked, blocks)

    of = scores.select("anchor_id", F.col("score").alias("positive_score"), F.col("w").cast("long").alias("window"))
    p = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(of, ["anchor_id", "positive_score"])
    n = negatives.select("anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return p.join(n, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
