"""Onset picking, suppression, matching and scoring.

The greedy steps are told without going along a file in one task: suppression by rounds of local maxima, spacing by
pointer doubling, matching by chunks that are matched alone and mended where they meet.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import truth_name
from ..sources.scratch import discard, staged
from .scan import carried, chunked, cut_points, overlapping

#: Rows of a file that a task takes together.
SIZE = 200_000


def pick_peaks(env: DataFrame, file: str, pos: str, value: str, delta: float, w: int = 3, wide: int = 10) -> DataFrame:
    """Frames that are the largest within ``w`` frames and at least ``delta`` above the mean within ``wide`` frames.

    Told by n * value >= sum + n * delta, which is exact for whole numbers and decimals: fractions held as doubles leave a
    value at the very threshold to rounding. Frames at one place go by value.
    """
    line = Window.partitionBy(file).orderBy(pos, value)
    near, around = line.rowsBetween(-w, w), line.rowsBetween(-wide, wide)
    rows = env.withColumns({"_top": F.max(value).over(near), "_sum": F.sum(value).over(around), "_n": F.count(value).over(around).cast("int")})
    high = F.col("_n") * F.col(value) >= F.col("_sum") + F.col("_n") * F.lit(delta)
    return rows.filter((F.col(value) == F.col("_top")) & high).drop("_top", "_sum", "_n")


def keep_apart(peaks: DataFrame, file: str, pos: str, gap: float, size: int = SIZE, value: str | None = None) -> DataFrame:
    """Greedy in order: a peak stays if the last kept one is more than ``gap`` before it.

    Every peak points to the first one more than ``gap`` later. One that no other stands within ``gap`` before is kept whatever came
    before, and so is what such heads reach. Pointers are doubled until none is left: as many joins as the logarithm of
    the longest way from a head. Rows without a file or place take no part; of rows that repeat a place the largest by ``value`` and then the other columns stays.
    """
    kind = dict(peaks.dtypes)[pos]
    at = peaks.select(F.col(file).alias("f"), F.col(pos).alias("p")).filter("f IS NOT NULL AND p IS NOT NULL").distinct()
    rows = carried(chunked(at, ["f"], "p", size), ["f"], {"_high": F.max("p")}, {"_back": lambda before, after: F.max("_high").over(before)})
    last = F.coalesce(F.lag("p").over(Window.partitionBy("f", "_chunk").orderBy("p")), F.col("_back"))
    nodes = staged(rows.select("f", "p", (last.isNull() | (F.col("p") - last > gap)).alias("head")), "peaks")

    # The first peak beyond p + gap: an as-of join of each peak's query with the peaks, from the end to the start.
    both = nodes.select("f", F.col("p").alias("_t"), F.lit(1).alias("_kind"), F.struct("p", "head").alias("_to"), F.lit(None).cast(kind).alias("_from"))
    both = both.unionByName(nodes.select("f", (F.col("p") + F.lit(gap).cast(kind)).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast(both.schema["_to"].dataType).alias("_to"), F.col("p").alias("_from")))
    rows = carried(chunked(both, ["f"], "_t", size), ["f"], {"_first": F.min("_to")}, {"_ahead": lambda before, after: F.last("_first", ignorenulls=True).over(after)})
    w = Window.partitionBy("f", "_chunk").orderBy(F.desc("_t"), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_next", F.coalesce(F.last("_to", ignorenulls=True).over(w), F.col("_ahead")))
    jump = staged(rows.filter("_kind = 0 AND NOT _next.head").select("f", F.col("_from").alias("p"), F.col("_next.p").alias("q")), "peak-jumps")
    kept, old = nodes.filter("head").select("f", "p"), []
    while not jump.isEmpty():
        reached = kept.join(jump, ["f", "p"]).select("f", F.col("q").alias("p"))
        kept = staged(kept.unionByName(reached).distinct(), "peaks-kept")
        further = jump.withColumnRenamed("q", "m").join(jump.select("f", F.col("p").alias("m"), "q"), ["f", "m"]).select("f", "p", "q")
        old += [kept, jump]
        jump = staged(further, "peak-jumps")
    discard(jump, *old[:-2], *old[-1:], *([nodes] if old else []))
    places = kept.select(F.col("f").alias("_f"), F.col("p").alias("_p"))
    rows = peaks.join(places, (F.col(file) == F.col("_f")) & (F.col(pos) == F.col("_p")), "left_semi")
    order = F.struct(*([value] if value else []), *[c for c, kind in peaks.dtypes if c != value and not kind.startswith("map")])
    return rows.groupBy(file, pos).agg(F.max_by(F.struct(*peaks.columns), order).alias("_row")).select("_row.*")


def pick_onsets(env: DataFrame, file: str, pos: str, value: str, delta: float, w: int = 3, wide: int = 10, gap: float = 3) -> DataFrame:
    return keep_apart(pick_peaks(env, file, pos, value, delta, w, wide), file, pos, gap, value=value)


def onset_confidence(wave: Column, onset: Column, half: int = 1102) -> Column:
    """The largest sample of the normalised wave in [onset - half, onset + half), cut at the wave's start."""
    start = F.greatest(onset - half, F.lit(0)).cast("int")
    return F.array_max(F.slice(wave, start + 1, F.greatest((onset + half).cast("int") - start, F.lit(0))))


def _rounds(onsets: DataFrame, window: float, rounds: int, size: int) -> DataFrame:
    """Onsets (f, p, c and others) with ``_state`` after so many rounds: 0 open, 1 kept, 2 suppressed.

    A round keeps each open onset that no stronger open one is near, then suppresses what is near a kept one. What a
    row becomes in a round is told by rows up to two windows away, so chunks have a halo of two windows a round.
    """
    rows = overlapping(onsets, ["f"], "p", F.lit(2.0 * rounds * window * (1 + 1e-9)), size)
    # Frames in units of the window, a little wider; who is near is told by the places themselves.
    rows = rows.withColumn("_u", F.col("p") / F.lit(window) * F.lit(1 - 1e-6)).withColumn("_state", F.lit(0))
    by = Window.partitionBy("f", "_chunk")
    rows = rows.withColumn("_same", F.lag("p").over(by.orderBy("_u", "p", F.desc("c"))) == F.col("p")).filter("_same IS NULL OR NOT _same").drop("_same")
    frame = by.orderBy("_u").rangeBetween(-1, 1)
    state, p, c = F.col("_state"), F.col("p"), F.col("c")
    for _ in range(rounds):
        rows = rows.withColumn("_near", F.collect_list(F.when(state == 0, F.struct("p", "c"))).over(frame))
        beaten = F.exists("_near", lambda x: (F.abs(x["p"] - p) < window) & ((x["c"] > c) | ((x["c"] == c) & (x["p"] > p))))
        rows = rows.withColumn("_state", F.when((state == 0) & ~beaten, 1).otherwise(state))
        rows = rows.withColumn("_near", F.collect_list(F.when(state == 1, p)).over(frame))
        rows = rows.withColumn("_state", F.when((state == 0) & F.exists("_near", lambda x: F.abs(x - p) < window), 2).otherwise(state))
    return rows.filter("_chunk = _home").drop("_near", "_u", "_chunk", "_home")


def _greedy(onsets: DataFrame, window: float) -> DataFrame:
    """The same by going along what is left of a file in one task: for chains of rising confidence that rounds take too long for."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        at, kept, rows = group["p"].to_numpy(), [], []
        for i in np.lexsort((-at, -group["c"].to_numpy())).tolist():
            q = float(at[i])
            k = bisect.bisect(kept, q)
            if (k == 0 or q - kept[k - 1] >= window) and (k == len(kept) or kept[k] - q >= window):
                kept.insert(k, q)
                rows.append(i)
        return group.iloc[rows]

    return onsets.groupBy("f").applyInPandas(run, onsets.schema)


def suppress(onsets: DataFrame, window: float, file: str = "file", pos: str = "pos", conf: str = "conf", size: int = SIZE, rounds: int = 3, passes: int = 8) -> DataFrame:
    """Greedy non-maximum suppression by falling confidence: a kept onset removes all others less than ``window`` away.

    Of equal confidences the later onset goes first, of onsets at one place the strongest. Under this total order the
    greedy result is what rounds of local maxima give, ``rounds`` at a time over all files in chunks, then again over what they leave
    open. Only files with chains of rising confidence that ``passes`` of them don't get to the end of are finished one task a file. Rows
    without a place or confidence take no part.
    """
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in onsets.columns]
    left = onsets.select(F.col(file).alias("f"), F.col(pos).cast("double").alias("p"), F.col(conf).alias("c"), F.struct(*columns).alias("row")).filter("p IS NOT NULL AND c IS NOT NULL")
    kept = []
    for _ in range(passes):
        told = staged(_rounds(left, window, rounds, size).filter("_state < 2"), "onset-rounds")
        kept.append(told.filter("_state = 1").drop("_state"))
        left = told.filter("_state = 0").drop("_state")
        if left.isEmpty():
            break
    else:
        kept.append(_greedy(left, window))
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out.select("row.*")


#: Onsets in a cell of a file beyond which the cell is split.
CELL = 10_000


def onset_candidates(pred: DataFrame, truth: DataFrame, window: float, file: str = "file", pos: str = "pos", cell: int = CELL) -> DataFrame:
    """Pairs less than ``window`` apart, all columns as ``pred_`` and ``truth_``: a band join as an equi-join on buckets of that width and their neighbours.

    A bucket of a file with more than ``cell`` predictions is split: its predictions are dealt out over slices, its
    truths copied to each.
    """
    named = lambda df, side: [file, *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != file]]
    at = F.floor(F.col(pos) / F.lit(window))
    p = pred.select(*named(pred, "pred"), at.alias("_b"))
    t = truth.select(*named(truth, "truth"), F.explode(F.array(*[at + d for d in (-1, 0, 1)])).alias("_b"))
    # Heavy cells are at most the predictions by ``cell``, or so many as fit a broadcast.
    total = F.broadcast(pred.agg(F.greatest(F.lit(cell), F.floor(F.count(F.lit(1)) / 20_000)).alias("_cell")))  # one row
    heavy = pred.groupBy(file, at.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).crossJoin(total).filter("_n > _cell")
    heavy = F.broadcast(heavy.select(file, "_b", F.ceil(F.col("_n") / F.col("_cell")).alias("_slices")))
    slices = F.coalesce("_slices", F.lit(1))
    p = p.join(heavy, [file, "_b"], "left").withColumn("_s", F.pmod(F.xxhash64(*[c for c, kind in p.dtypes if not kind.startswith("map")]), slices)).drop("_slices")
    t = t.join(heavy, [file, "_b"], "left").withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))).drop("_slices")
    return p.join(t, [file, "_b", "_s"]).filter(F.abs(F.col(f"pred_{pos}") - F.col(f"truth_{pos}")) < window).drop("_b", "_s")


def _match(at: list[float], conf: list[float], free: list[bool], truths: list[float], window: float) -> list[int]:
    """For each truth in order the number of the prediction it takes, or -1; ``at`` ascends, ``free`` is kept up to date."""
    took, reach = [], window * (1 + 1e-9)
    for g in truths:
        best = -1
        for i in range(bisect.bisect_left(at, g - reach), bisect.bisect_right(at, g + reach)):
            if free[i] and abs(at[i] - g) < window and (best < 0 or conf[i] >= conf[best]):
                best = i
        if best >= 0:
            free[best] = False
        took.append(best)
    return took


def _ordered(table: pa.Table, *by: str) -> tuple[list, ...]:
    """The columns of a group in the order of ``by``, as lists."""
    table = table.sort_by([(c, "ascending") for c in by])
    return tuple(table.column(c).to_pylist() for c in table.column_names)


def match_onsets(pred: DataFrame, truth: DataFrame, window: float, compat: bool = False, size: int = SIZE) -> DataFrame:
    """file, y, score, hit: one-to-one greedy matching in order of the truths.

    A truth takes the most confident free prediction less than ``window`` away (ties: the later one) and gives
    (1, confidence); without one (1, 0). Predictions left over give (0, confidence). ``compat`` stops at the truth
    that takes the last prediction, as the published evaluation does, so later truths give no row.

    A file of more than about ``size`` onsets is cut into chunks. All are matched alone at first; then those are matched
    again for which earlier chunks, by what they gave last, have taken other predictions than thought, until none is.
    Rows without a file or place take no part.
    """
    kind = dict(pred.dtypes)["file"]
    p = pred.select("file", F.col("pos").cast("double").alias("pos"), F.col("conf").cast("double").alias("conf")).filter("file IS NOT NULL AND pos IS NOT NULL")
    t = truth.select(F.col("file").cast(kind).alias("file"), F.col("pos").cast("double").alias("pos")).filter("file IS NOT NULL AND pos IS NOT NULL")
    places = p.select("file", "pos").unionByName(t)
    if places.groupBy("file").count().filter(F.col("count") > size).isEmpty():

        def alone(key: tuple, p: pa.Table, t: pa.Table) -> pa.Table:
            (at, conf), (truths,) = _ordered(p.select(["pos", "conf"]), "pos", "conf"), _ordered(t.select(["pos"]), "pos")
            free = [True] * len(at)
            took = _match(at, conf, free, truths, window)
            if compat and at and not any(free):
                took = took[: max(i for i, x in enumerate(took) if x >= 0) + 1]
            left = [c for c, f in zip(conf, free, strict=True) if f]
            y = pa.array([1] * len(took) + [0] * len(left), pa.int32())
            score, hit = [conf[i] if i >= 0 else 0.0 for i in took] + left, [i >= 0 for i in took] + [False] * len(left)
            file = (p if len(p) else t).column("file").type
            return pa.table({"file": pa.array([key[0].as_py()] * len(y), file), "y": y, "score": pa.array(score, pa.float64()), "hit": pa.array(hit, pa.bool_())})

        return p.groupBy("file").cogroup(t.groupBy("file")).applyInArrow(alone, f"file {kind}, y int, score double, hit boolean")

    cuts = staged(cut_points(places, ["file"], "pos", size), "onset-cuts")
    t = staged(overlapping(t, ["file"], "pos", F.lit(0), size, cuts).select("file", "pos", F.monotonically_increasing_id().alias("t"), "_chunk"), "onset-truths")
    p = p.withColumn("n", F.monotonically_increasing_id())
    p = staged(overlapping(p, ["file"], "pos", F.lit(window * (1 + 1e-9)), size, cuts), "onset-predictions")
    given = f"file {kind}, t long, pos double, took long, score double, _chunk int"

    def chunk(key: tuple, p: pa.Table, t: pa.Table) -> pa.Table:
        n, at, conf, free = _ordered(p.select(["n", "pos", "conf", "free"]), "pos", "conf", "n")
        t = t.sort_by([("pos", "ascending"), ("t", "ascending")])
        took = _match(at, conf, free, t.column("pos").to_pylist(), window)
        return t.select(["file", "t", "pos"]).append_column("took", pa.array([n[i] if i >= 0 else -1 for i in took], pa.int64())).append_column("score", pa.array([conf[i] if i >= 0 else 0.0 for i in took], pa.float64())).append_column("_chunk", t.column("_chunk"))

    def joined(chunks: DataFrame | None, taken: DataFrame) -> DataFrame:
        """The matching of the chunks named, all of them at first, given what others have taken."""
        # An earlier chunk's prediction is gone. The first chunk to take one counts: later ones will be told.
        mine = p.join(taken, "n", "left").withColumn("free", F.col("_by").isNull() | (F.col("_by") >= F.col("_chunk"))).drop("_by", "_home")
        own = t
        if chunks is not None:
            mine, own = (x.join(chunks, ["file", "_chunk"], "left_semi") for x in (mine, t))
        return mine.groupBy("file", "_chunk").cogroup(own.groupBy("file", "_chunk")).applyInArrow(chunk, given)

    by = lambda told: told.filter("took >= 0").groupBy(F.col("took").alias("n")).agg(F.min("_chunk").alias("_by"))
    none = p.select("n", F.lit(0).alias("_by")).limit(0)
    told, gone, done = staged(joined(None, none), "onset-matches"), None, []
    while True:
        # What each chunk finds gone; the sums tell whether that is what its matching was given.
        now = p.join(by(told), "n").filter("_by < _chunk").groupBy("file", "_chunk").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("n").cast("decimal(20, 0)")).alias("s"))
        now = staged(now, "onset-gone")
        changed = now if gone is None else now.join(gone, ["file", "_chunk", "m", "s"], "left_anti").unionByName(gone.join(now, ["file", "_chunk", "m", "s"], "left_anti"))
        changed = staged(changed.select("file", "_chunk").distinct(), "onset-changed")
        done += [now, changed]
        if changed.isEmpty():
            break
        again = staged(told.join(changed, ["file", "_chunk"], "left_anti").unionByName(joined(changed, by(told))), "onset-matches")
        done.append(told)
        told, gone = again, now
    discard(cuts, *done)
    free = p.filter("_chunk = _home").join(told.select(F.col("took").alias("n")), "n", "left_anti")
    if compat:
        ends = told.groupBy("file").agg(F.count_if(F.col("took") >= 0).alias("m"), F.max(F.when(F.col("took") >= 0, F.struct("pos", "t"))).alias("end"))
        ends = p.filter("_chunk = _home").groupBy("file").agg(F.count(F.lit(1)).alias("of")).join(ends, "file").filter("m = of").select("file", "end")
        told = told.join(ends, "file", "left").filter("end IS NULL OR struct(pos, t) <= end")
    hits = told.select("file", F.lit(1).alias("y"), "score", (F.col("took") >= 0).alias("hit"))
    return hits.unionByName(free.select("file", F.lit(0).alias("y"), F.col("conf").alias("score"), F.lit(False).alias("hit")))


def average_precision(pairs: DataFrame, group: str, y: str = "y", score: str = "score") -> DataFrame:
    """Per group: AP, the sum of recall gains times precision over distinct score thresholds, and F1 at score > 0."""
    tied = pairs.groupBy(group, score).agg(F.sum(y).alias("_pos"), F.count(F.lit(1)).alias("_n"))
    down = Window.partitionBy(group).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    cum = tied.withColumn("_tp", F.sum("_pos").over(down)).withColumn("_all", F.sum("_n").over(down)).withColumn("_total", F.sum("_pos").over(Window.partitionBy(group)))
    ap = cum.groupBy(group).agg(F.coalesce(F.sum(F.try_divide(F.col("_pos"), F.col("_total")) * F.col("_tp") / F.col("_all")), F.lit(0.0)).alias("ap"))
    said = F.col(score) > 0
    counts = pairs.groupBy(group).agg(F.count_if(said & (F.col(y) == 1)).alias("_tp"), F.count_if(said & (F.col(y) == 0)).alias("_fp"), F.count_if(~said & (F.col(y) == 1)).alias("_fn"))
    f1 = counts.select(group, F.coalesce(F.try_divide(2.0 * F.col("_tp"), 2 * F.col("_tp") + F.col("_fp") + F.col("_fn")), F.lit(0.0)).alias("f1"))
    return ap.join(f1, group)


def pair_truth(pred: DataFrame, truth: DataFrame, name: str = "name") -> DataFrame:
    """Each prediction file with its ground truth, whose name derives from its own; columns as ``pred_`` and ``truth_``."""
    p = pred.select(*[F.col(c).alias(f"pred_{c}") for c in pred.columns])
    t = truth.select(*[F.col(c).alias(f"truth_{c}") for c in truth.columns])
    return p.join(t, truth_name(F.col(f"pred_{name}")) == F.col(f"truth_{name}"))


def score_onsets(matched: DataFrame, truth: DataFrame) -> DataFrame:
    """file, acc, ap, f1. Accuracy: hits over all truths, 0 without any."""
    n = truth.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    hits = matched.groupBy("file").agg(F.count_if("hit").alias("_h")).join(n, "file", "left")
    acc = hits.select("file", F.coalesce(F.try_divide(F.col("_h").cast("double"), F.col("_n")), F.lit(0.0)).alias("acc"))
    return acc.join(average_precision(matched, "file"), "file")
