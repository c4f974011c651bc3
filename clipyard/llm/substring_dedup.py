"""Near-duplicate passages by compact windows of token min-hashes.

A token is a word shingle. Under each of several hash functions a text's compact windows are the nodes of its Cartesian
tree: all runs of the least passage length or more inside a window have their min-hash at the window's centre, so a
window stands for very many passages. Only repeated tokens take part, and only stretches where a passage can repeat at
all: three quarters of its tokens occur twice in the corpus.

Windows meet on (function, min-hash). Of a key of few windows all pairs of texts are joined: the windows that a pair
shares under different functions must overlap on both sides by the least length (interval join, ``min_hits`` functions).
A key of many windows has all its texts meet the first. Candidate texts are verified as a whole: runs of equal tokens on
any diagonal are chained, and the widest joined spans whose token sets are similar enough are passages; stretches
whose tokens are shared in another order are compared as sets. What no passage covers after that of a hot key's windows
is compared with all earlier windows of the key, in blocks of bounded size, through an inverted index: one sum along a
window tells for every other one where a similar span may lie, and those that cover most of what is open are verified
first, until nothing that any may cover is open.

Two passages of Jaccard similarity J share their min-hash under a function with probability J or more, so a pair of
J = 0.75 is missed with probability 0.005 at most (two functions of six); equal passages of the least length share all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import all_columns, discard, gives_back, staged
from .shingles import TextShingles, mix, repeated_shingles, text_shingles

#: All pairs of a key's windows are candidates up to so many windows.
FEW = 8
#: Windows in a block of a hot key, and their tokens.
BLOCK, BLOCK_TOKENS = 2000, 400_000


def compact_windows(v: np.ndarray, least: int, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, c, last): positions c that are the smallest of some ``least`` positions in a row, and how far such rows reach.

    These are the Cartesian tree's nodes of ``least`` or more positions, each cut to ``least`` - 1 on both sides of
    c; of equal values the leftmost counts. ``starts``: where a row of positions may begin, in a sequence of several
    texts; else everywhere.
    """
    n = len(v)
    if n < least:
        e = np.zeros(0, np.int64)
        return e, e, e
    low, span = v, 1
    while 2 * span <= least:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < least:
        low = np.minimum(low[: n - least + 1], low[least - span : least - span + n - least + 1])
    at = np.arange(len(low)) if starts is None else starts
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1] + least - 1
    c = np.empty(len(first), np.int64)
    for a in range(0, len(first), 4_000):
        f = first[a : a + 4_000]
        c[a : a + 4_000] = f + np.argmax(v[f[:, None] + np.arange(least)] == low[begin[a : a + 4_000]][:, None], axis=1)
    return first, c, last


def stretches(rep: np.ndarray, percent: int, least: int, free: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Maximal [start, end) of ``least`` or more in which every place lies in a row with ``percent`` of ``rep`` or more; ``free`` places don't count against it."""
    if len(rep) < least:
        return []
    cost = np.where(rep, 100 - percent, -percent)
    if free is not None:
        cost[free & ~rep] = 0
    sums = np.concatenate(([0], np.cumsum(cost)))
    on = np.maximum.accumulate(sums[::-1])[::-1][1:] >= np.minimum.accumulate(sums)[:-1]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], on.view(np.int8), [0]))))
    return [(int(s), int(e)) for s, e in zip(edge[::2], edge[1::2], strict=True) if e - s >= least and rep[s:e].any()]


def window_keys(tokens: np.ndarray, on: np.ndarray, least: int, functions: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, c, first, end) of the compact windows under each function, over the tokens that are ``on``; a key's last three bits are its function."""
    out = []
    for f in range(functions):
        rank = np.where(on, mix(tokens, f) >> np.uint64(1), np.uint64(1 << 63) + np.arange(len(tokens), dtype=np.uint64))
        first, c, last = compact_windows(rank, least, starts)
        use = on[c]
        first, c, last = first[use], c[use], last[use]
        out.append(((mix(tokens[c], 64 + f) & ~np.uint64(7)) | np.uint64(f), c, first, last + 1))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


ROWS = "doc_id long, uid long, tid long, n int, tokens binary, keys array<long>, lo array<int>, hi array<int>"


def _rows(shared, least: int, percent: int, width: int, functions: int):
    def some(flat: np.ndarray, bounds: np.ndarray, twice: np.ndarray) -> tuple[list[int], list[bytes], list[np.ndarray], np.ndarray]:
        """Texts with windows, their tokens in stretches (zeros elsewhere), and the windows by text."""
        sums, owners, spans = np.concatenate(([0], np.cumsum(twice))), [], []
        size = np.diff(bounds)
        for i in np.flatnonzero((size >= least) & (100 * (sums[bounds[1:]] - sums[bounds[:-1]]) >= percent * least)).tolist():
            for s, e in stretches(twice[bounds[i] : bounds[i + 1]], percent, least):
                owners.append(i)
                spans.append((bounds[i] + s, bounds[i] + e))
        if not spans:
            return [], [], [], np.zeros(1, np.int64)
        at = np.concatenate([np.arange(s, e) for s, e in spans])
        ends = np.cumsum([e - s for s, e in spans])
        starts = np.concatenate([np.arange(x - (e - s), x - least + 1) for (s, e), x in zip(spans, ends, strict=True)])
        own, on = flat[at], twice[at]
        key, c, first, end = window_keys(own, on, least, functions, starts)
        owner = np.repeat(owners, [e - s for s, e in spans])
        order = np.argsort(owner[c], kind="stable")
        whose = owner[c][order]
        lo, hi = at[first][order] - bounds[whose], at[end - 1][order] + 1 - bounds[whose]
        texts, cuts = np.unique(whose, return_index=True)
        # 32 bits of a token's hash; what lies in no stretch or occurs once equals nothing: zeros, which compress.
        value = np.zeros(len(flat), "<u4")
        value[at] = np.where(on, np.maximum(own >> np.uint64(32), np.uint64(1)), np.uint64(0))
        return texts.tolist(), [value[bounds[i] : bounds[i + 1]].tobytes() for i in texts], [key[order].view(np.int64), lo.astype(np.int32), hi.astype(np.int32)], np.append(cuts, len(key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, hashes = shared.value, TextShingles(width)
        for batch in batches:
            for a, _, flat, bounds in hashes.parts(batch.column(3)):
                took, tokens, lists, cuts = some(flat, bounds, rep.seen_twice(flat))
                if took:
                    where, cut = pa.array([a + i for i in took], pa.int64()), pa.array(cuts.astype(np.int32))
                    sizes = [int(bounds[i + 1] - bounds[i]) + width - 1 for i in took]
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(where) for k in range(3)], pa.array(sizes, pa.int32()), pa.array(tokens, pa.binary()), *[pa.ListArray.from_arrays(cut, pa.array(x)) for x in lists]], names=["doc_id", "uid", "tid", "n", "tokens", "keys", "lo", "hi"])

    return gives_back(run)


class Extensions:
    """How far two token arrays agree on both sides of places, by polynomial hashes of their prefixes and binary search."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, a: np.ndarray, b: np.ndarray):
        n = max(len(a), len(b)) + 1
        self.power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, self.BASE))), dtype=np.uint64)
        self.sizes = len(a), len(b)
        self.sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(x.astype(np.uint64)) * self.power[: len(x)], dtype=np.uint64))) for x in (a, b)]

    def equal(self, i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
        """Whether a[i:i+n] and b[j:j+n] are alike (by 64 bits)."""
        x, y = self.sums
        return (x[i + n] - x[i]) * self.power[j] == (y[j + n] - y[j]) * self.power[i]

    def uncovered(self, least: int, covered: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of ``least`` or more so that every place of a that such a run holds is covered, by them or before: the first stretch of so many tokens with an open place that b has, and so on behind its run."""
        ends, out = [len(x) - least for x in self.sums], []
        if min(ends) <= 0:
            return out
        top = len(self.power) - 1
        one, two = ((x[least:] - x[:-least]) * self.power[top - np.arange(e)] for x, e in zip(self.sums, ends, strict=True))
        open_ = np.concatenate(([0], np.cumsum(~covered)))
        i = np.flatnonzero(open_[least:][: len(one)] > open_[: len(one)])
        by = np.argsort(two, kind="stable")
        held = two[by]
        at = np.searchsorted(held, one[i])
        fits = held[np.minimum(at, len(held) - 1)] == one[i]
        i, j, k = i[fits], by[at[fits]], 0
        while k < len(i):
            # Runs of 16 places at a time; those behind a run are looked up in their turn.
            some = slice(k, k + 16)
            back, ahead = self.reach(i[some], j[some])
            first = k
            while k < min(first + 16, len(i)):
                s, n = i[k] - back[k - first], back[k - first] + ahead[k - first]
                out.append(tuple(np.array([x]) for x in (s, j[k] - back[k - first], n)))
                k = max(k + 1, int(np.searchsorted(i, s + n - least + 1)))
        return out

    def runs(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, size) of the longest equal runs that hold each pair of equal places, without repeats."""
        back, ahead = self.reach(i, j)
        s, s2, n = i - back, j - back, back + ahead
        _, first = np.unique(s * (self.sizes[1] + 1) + s2, return_index=True)
        return s[first], s2[first], n[first]

    def reach(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens are equal before each pair of places, and from it on."""
        k = len(i)
        most = np.concatenate((np.minimum(i, j), np.minimum(self.sizes[0] - i, self.sizes[1] - j)))  # back, then ahead
        x, y, got, back = np.concatenate((i, i)), np.concatenate((j, j)), np.zeros(2 * k, np.int64), np.arange(2 * k) < k
        for bit in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
            step = 1 << bit
            fits = np.flatnonzero(got + step <= most)
            off = np.where(back[fits], -got[fits] - step, got[fits])
            got[fits] += step * self.equal(x[fits] + off, y[fits] + off, step)
        return got[:k], got[k:]


_PLACE = (1 << 31) - 1


def in_order(v: np.ndarray) -> np.ndarray:
    """The places of small values, none negative, by value and place: a stable sort."""
    both = (v.astype(np.int64) << 31) | np.arange(len(v))
    both.sort()
    return both & _PLACE


def equal_runs(a: np.ndarray, b: np.ndarray, least: int = 46) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, size): the longest runs of equal tokens of ``a`` from i and ``b`` from j, by i; tokens are under 2^32 and none negative.

    All pairs of a token's places are looked at if they are 64 or fewer; of a token that is frequent in both, its
    places pair in turn. Each run is as long as it can be on both sides. What runs of ``least`` tokens or more these miss holds
    frequent tokens only, and is found by the hashes of all stretches of that length: every place of ``a`` that such a run holds is in one of them.
    """
    order = in_order(b)
    by = b[order]
    low, high = np.searchsorted(by, a), np.searchsorted(by, a, side="right")
    n = high - low
    mine = in_order(a)
    first = np.flatnonzero(np.concatenate(([True], a[mine[1:]] != a[mine[:-1]]))) if len(a) else mine
    sizes = np.diff(np.append(first, len(a)))
    turn, times = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
    turn[mine] = np.arange(len(a)) - np.repeat(first, sizes)
    times[mine] = np.repeat(sizes, sizes)
    dense = n * times > 64
    few = np.where(dense, 0, n)
    i = np.repeat(np.arange(len(a)), few)
    j = order[np.repeat(low - np.cumsum(few) + few, few) + np.arange(len(i))]
    at = np.flatnonzero(dense)
    if len(at):
        paired = at[turn[at] < n[at]]
        i, j = np.concatenate((i, paired)), np.concatenate((j, order[low[paired] + turn[paired]]))
    by_diagonal = ((j - i + len(a)) << 31) | i
    by_diagonal.sort()
    i = by_diagonal & _PLACE
    j = (by_diagonal >> 31) + i - len(a)
    first = np.flatnonzero(np.concatenate(([True], np.diff(by_diagonal) != 1))) if len(i) else i
    i, j, size = i[first], j[first], np.diff(np.append(first, len(i)))
    if len(at):
        both = None
        e, e2 = i + size, j + size
        more = ((i > 0) & (j > 0) & (a[i - 1] == b[j - 1])) | ((e < len(a)) & (e2 < len(b)) & (a[np.minimum(e, len(a) - 1)] == b[np.minimum(e2, len(b) - 1)]))
        if more.any():
            both = Extensions(a, b)
            i, j, size = (np.concatenate((x[~more], y)) for x, y in zip((i, j, size), both.runs(i[more], j[more]), strict=True))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], dense.view(np.int8), [0]))))
        if (edge[1::2] - edge[::2] >= least).any():
            long = size >= least
            cover = np.zeros(len(a) + 1, np.int64)
            np.add.at(cover, i[long], 1)
            np.add.at(cover, (i + size)[long], -1)
            parts = [(i, j, size), *(both or Extensions(a, b)).uncovered(least, np.cumsum(cover)[:-1] > 0)]
            i, j, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, first = np.unique(i * (len(b) + 1) + j, return_index=True)
            i, j, size = i[first], j[first], size[first]
    order = np.lexsort((j, i))
    return i[order], j[order], size[order]


def chains(i: np.ndarray, j: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Runs joined in step: each to the one before it if that is near, else to the nearest earlier one in step, if it is that one's nearest too."""
    n, far = len(i), np.iinfo(np.int64).max
    if n and (np.diff(j) > 0).all():
        return [np.arange(n)]
    before, cost = np.full(n, -1), np.full(n, far)
    near = np.abs(i[1:] - i[:-1] - size[:-1]) + np.abs(j[1:] - j[:-1] - size[:-1])
    easy = (j[1:] > j[:-1]) & (i[1:] > i[:-1]) & (near <= 16)
    before[1:][easy], cost[1:][easy] = np.flatnonzero(easy), near[easy]
    for k in np.flatnonzero(before < 0)[1:].tolist():
        di, dj = i[k] - (i[:k] + size[:k]), j[k] - (j[:k] + size[:k])
        away = np.abs(di) + np.abs(dj)
        away[(j[:k] >= j[k]) | (i[:k] >= i[k]) | (di + size[k] <= 0) | (dj + size[k] <= 0)] = far
        q = k - 1 - int(np.argmin(away[::-1]))
        if away[q] < far:
            before[k], cost[k] = q, away[q]
    after: dict[int, int] = {}
    for k in np.argsort(cost, kind="stable").tolist():
        if before[k] >= 0:
            after.setdefault(int(before[k]), k)
    out, joined = [], set(after.values())
    for k in range(n):
        if k not in joined:
            path = [k]
            while path[-1] in after:
                path.append(after[path[-1]])
            out.append(np.array(path))
    return out


def small_ids(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of ``a``, ids of ``b``, the earlier place of the same id in ``a``, in ``b``, which ids both have): equal tokens have equal ids, each zero its own; negative: no earlier place."""
    v = np.concatenate((a, b))
    on = np.flatnonzero(v)
    both = (v[on].astype(np.int64) << 31) | on
    both.sort()
    token, at = both >> 31, both & _PLACE
    same = token[1:] == token[:-1]
    ids, earlier = np.empty(len(v), np.int64), np.full(len(v), -1)
    rank = np.cumsum(np.concatenate(([False], ~same))) if len(on) else on
    ids[at] = rank
    zeros = np.flatnonzero(v == 0)
    ids[zeros] = len(on) + np.arange(len(zeros))
    earlier[at[1:][same]] = at[:-1][same]
    shared = np.zeros(len(v), bool)
    # Of an id's places those in a come first.
    shared[rank[1:][same & (at[:-1] < len(a)) & (at[1:] >= len(a))]] = True
    return ids[: len(a)], ids[len(a) :], earlier[: len(a)], earlier[len(a) :] - len(a), shared


def chain_spans(s, e, s2, e2, least: int, percent: int, lack: list[np.ndarray] | None) -> Iterator[tuple[int, int]]:
    """(first run, last run) of a chain's spans that may be similar, the widest first; with ``lack`` (tokens repeat) all such spans, else of each first run the widest, which is similar."""
    n = e - s
    total = np.concatenate(([0], np.cumsum(n)))
    found = []
    for a in range(0, len(s), 256):
        at = slice(a, a + 256)
        wide, wide2 = e[None, :] - s[at, None], e2[None, :] - s2[at, None]
        if lack is None:
            equal = total[None, 1:] - total[:-1][at, None]
            may = 100 * equal >= percent * (wide + wide2 - equal)
        else:  # tokens that repeat in a span count once, so only what the other side lacks decides
            lacks = sum(x[t][None, :] - x[f][at, None] for x, f, t in ((lack[0], s, e), (lack[1], s2, e2)))
            may = (100 - percent) * np.minimum(wide, wide2) >= percent * lacks
        may &= (wide >= least) & (wide2 >= least)
        if lack is None:
            left = np.flatnonzero(may.any(axis=1))
            right = may.shape[1] - 1 - np.argmax(may[left, ::-1], axis=1)
        else:
            left, right = np.nonzero(may)
        found.append((wide[left, right], left + a, right))
    wide, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(-wide, kind="stable")
    return zip(left[order].tolist(), right[order].tolist(), strict=True)


def unordered_spans(i: np.ndarray, j: np.ndarray, size: np.ndarray, least: int, percent: int, lack: list[np.ndarray] | None) -> Iterator[tuple[int, int, tuple[int, int, int, int]]]:
    """(first run, last run, span on both sides) of neighbouring runs, by i, that may be similar in whatever order the other side has them, the widest first."""
    e, e2, total = i + size, j + size, np.concatenate(([0], np.cumsum(size)))
    found = []
    for a in range(0, len(i), 256):
        rows = np.arange(a, min(a + 256, len(i)))[:, None]
        later = np.arange(len(i)) >= rows
        big = np.int64(1) << 40
        end = np.maximum.accumulate(np.where(later, e, -1), axis=1)
        low2 = np.minimum.accumulate(np.where(later, j, big), axis=1)
        high2 = np.maximum.accumulate(np.where(later, e2, -1), axis=1)
        wide, wide2 = end - i[rows], high2 - low2
        equal = np.minimum(total[None, 1:] - total[rows], np.minimum(wide, wide2))
        may = later & (wide >= least) & (wide2 >= least) & (100 * equal >= percent * (wide + wide2 - equal))
        left, right = np.nonzero(may)
        if lack is not None:  # what the other side lacks is in no intersection
            lacks = lack[0][end[left, right]] - lack[0][i[left + a]] + lack[1][high2[left, right]] - lack[1][low2[left, right]]
            fine = (100 - percent) * np.minimum(wide[left, right], wide2[left, right]) >= percent * lacks
            left, right = left[fine], right[fine]
        found.append((wide[left, right], left + a, right, end[left, right], low2[left, right], high2[left, right]))
    wide, left, right, end, low2, high2 = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 6
    for k in np.argsort(-wide, kind="stable").tolist():
        yield int(left[k]), int(right[k]), (int(i[left[k]]), int(end[k]), int(low2[k]), int(high2[k]))


def joined_spans(a: np.ndarray, b: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    """(start, end, source start, source end, jaccard): spans of ``a`` and ``b`` of ``least`` or more tokens whose sets are similar; zeros are tokens that equal nothing.

    A span begins and ends with shared tokens. Of the spans along a chain the widest come first, until they hold every run that
    a similar span holds.
    """
    out: list[tuple[int, int, int, int, float]] = []
    if min(len(a), len(b)) < least:
        return out
    a, b, before_a, before_b, shared = small_ids(a, b)
    in_b = shared[a]
    where = np.flatnonzero(in_b)
    if 100 * len(where) < percent * least:
        return out
    in_a = shared[b]
    where_b = np.flatnonzero(in_a)
    (a0, a1), (b0, b1) = ((int(x[0]), int(x[-1]) + 1) for x in (where, where_b))
    if min(a1 - a0, b1 - b0) < least:
        return out
    plain = (before_a[where] < 0).all() and (before_b < 0).all()  # no shared token repeats
    a, b, in_b, in_a, before_a, before_b = a[a0:a1], b[b0:b1], in_b[a0:a1], in_a[b0:b1], before_a[a0:a1] - a0, before_b[b0:b1] - b0
    again_a, again_b = (None, None) if plain else (before_a >= 0, before_b >= 0)
    on_a, on_b = stretches(in_b, percent, least, again_a), stretches(in_a, percent, least, again_b)
    if not on_a or not on_b:
        return out
    among = np.zeros(len(shared), bool)

    def similar(s: int, e: int, s2: int, e2: int) -> bool:
        if plain:
            at = partner[s:e]
            both = int(np.count_nonzero((at >= s2) & (at < e2)))
            union = e - s + e2 - s2 - both
        else:
            x, y = a[s:e][before_a[s:e] < s], b[s2:e2]
            among[y] = True
            both = int(np.count_nonzero(among[x]))
            among[y] = False
            union = len(x) + int(np.count_nonzero(before_b[s2:e2] < s2)) - both
        if fine := 100 * both >= percent * union:
            out.append((s, e, s2, e2, both / union))
        return fine

    lack = None
    if plain:
        i = where - a0
        partner = np.empty(len(shared), np.int64)
        partner[b] = np.arange(len(b))
        j = partner[a[i]]
        partner = np.full(len(a), -1)
        partner[i] = j
        first = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 1) | (np.diff(j) != 1))))
        i, j, size = i[first], j[first], np.diff(np.append(first, len(i)))
    else:
        i, j, size = equal_runs(a, b, least)
        lack = [np.concatenate(([0], np.cumsum(x))) for x in (~in_b & ~again_a, ~in_a & ~again_b)]
    begins, begins2, sizes = i.tolist(), j.tolist(), size.tolist()
    for path in chains(i, j, size):
        first, last = int(path[0]), int(path[-1])
        if min(begins[last] - begins[first], begins2[last] - begins2[first]) + sizes[last] < least:
            continue
        s, s2, n = i[path], j[path], size[path]
        e, e2 = s + n, s2 + n
        if similar(int(s[0]), int(e[-1]), int(s2[0]), int(e2[-1])):
            continue
        held = np.zeros(len(path), bool)
        for l, r in chain_spans(s, e, s2, e2, least, percent, lack):
            if not held[l : r + 1].all() and similar(int(s[l]), int(e[r]), int(s2[l]), int(e2[r])):
                held[l : r + 1] = True
    # Shared in another order: what the chains left, as sets; first whole stretches, then runs that stand together.
    def whole(spans: list[tuple[int, int]], shares: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, end, distinct tokens, shared distinct ones) of stretches from their first to their last shared token."""
        ends = [x + np.flatnonzero(shares[x:y])[[0, -1]] for x, y in spans]
        once = [before[x : y + 1] < x for x, y in ends]
        return tuple(np.array(z) for z in ([x for x, _ in ends], [y + 1 for _, y in ends], [np.count_nonzero(f) for f in once], [np.count_nonzero(f & shares[x : y + 1]) for f, (x, y) in zip(once, ends, strict=True)]))

    if apart := [x for x in on_a if not any(y[0] < x[1] and x[0] < y[1] for y in out)]:
        (s, e, n, m), (s2, e2, n2, m2) = whole(apart, in_b, before_a), whole(on_b, in_a, before_b)
        most = np.minimum(m[:, None], m2[None, :])
        may = (e - s >= least)[:, None] & (e2 - s2 >= least)[None, :] & (100 * most >= percent * (n[:, None] + n2[None, :] - most))
        for x, y in zip(*(z.tolist() for z in np.nonzero(may)), strict=True):
            similar(int(s[x]), int(e[x]), int(s2[y]), int(e2[y]))
    open_ = np.ones(len(a) + 1, bool)
    for s, e, *_ in out:
        open_[s:e] = False
    rest = np.flatnonzero(np.add.reduceat(open_, np.stack((i, i + size), axis=1).ravel())[::2] > 0) if len(i) else np.zeros(0, np.int64)
    for sides in ((i, j), (j, i)):
        if 100 * size[rest].sum() < percent * least:
            break
        flip = sides[0] is j
        (from_, to), (from2, to2) = (np.array(z).T for z in ((on_b, on_a) if flip else (on_a, on_b)))

        def enough(mine: np.ndarray, side: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[int]:
            """Stretches in which runs stand that are long enough together."""
            return np.flatnonzero(100 * (((side[mine] < end[:, None]) & (side[mine] + size[mine] > begin[:, None])) @ size[mine]) >= percent * least).tolist() if len(mine) else []

        for x in enough(rest, sides[0], from_, to):
            mine = rest[(sides[0][rest] < to[x]) & (sides[0][rest] + size[rest] > from_[x])]
            for y in enough(mine, sides[1], from2, to2):
                own = mine[(sides[1][mine] < to2[y]) & (sides[1][mine] + size[mine] > from2[y])]
                if size[own].sum() * 100 < percent * least or len(own) == 1:  # a long run alone is held by a chain's span
                    continue
                own = own[np.argsort(sides[0][own], kind="stable")]
                held = np.zeros(len(own), bool)
                for l, r, (s, e, s2, e2) in unordered_spans(sides[0][own], sides[1][own], size[own], least, percent, lack if lack is None or not flip else lack[::-1]):
                    if not held[l : r + 1].all() and similar(*((s2, e2, s, e) if flip else (s, e, s2, e2))):
                        held[l : r + 1] = True
                rest, mine = (np.setdiff1d(z, own[held], assume_unique=True) for z in (rest, mine))
    return [(s + a0, e + a0, s2 + b0, e2 + b0, x) for s, e, s2, e2, x in out]


FOUND = "doc_id long, uid long, start int, end int, source_id long, source_start int, source_end int, jaccard double"
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]


def _found(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * 8
    return pa.table([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])


def _verify(least: int, percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                out, part = [], batch.slice(first, 500)
                for doc, uid, tokens, s_doc, s_tokens in zip(*(part.column(c).to_pylist() for c in ("doc_id", "uid", "tokens", "s_doc", "s_tokens")), strict=True):
                    for s, e, s2, e2, jaccard in joined_spans(np.frombuffer(tokens, np.uint32), np.frombuffer(s_tokens, np.uint32), least, percent):
                        out.append((doc, uid, s, e + width - 1, s_doc, s2, e2 + width - 1, jaccard))
                yield from _found(out).to_batches()

    return gives_back(run)


def laid_out(tokens: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all windows' tokens one after the other, where each begins and the last ends)."""
    data = tokens.to_pylist()
    return np.frombuffer(b"".join(data), np.uint32), np.cumsum([0, *(len(x) // 4 for x in data)])


def places_of(flat: np.ndarray, bounds: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group and token in one value, window, first and last place, count, index by place) of each window's distinct tokens, by value and window; zeros are none, -1 by place."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    on = np.flatnonzero(flat)
    value = (group[owner[on]] << 32) | flat[on]
    by = np.argsort(value, kind="stable")  # windows and places come in turn
    value, at = value[by], on[by]
    own = owner[at]
    first = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (own[1:] != own[:-1])))) if len(at) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(at)))
    of = np.full(len(flat), -1)
    of[at] = np.repeat(np.arange(len(first)), count)
    place = at - bounds[own]
    return value[first], own[first], place[first], place[first + count - 1], count, of


class Windows:
    """Windows of many keys, each key's in order, with an inverted index of their tokens' places."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray, group: np.ndarray):
        value, self.owner, self.place, self.last, count, _ = places_of(flat, bounds, group)
        new = np.concatenate(([True], value[1:] != value[:-1])) if len(value) else np.zeros(0, bool)
        self.value, self.count = value[new], len(group)
        self.posting = (np.cumsum(new) - 1) * (self.count + 1) + self.owner  # by value and window
        self.twice = np.bincount(self.owner[count > 1], minlength=len(group)) > 0

    def covers(self, flat: np.ndarray, bounds: np.ndarray, group: np.ndarray, open_: np.ndarray, begin: np.ndarray, before: np.ndarray, least: int, percent: int, most: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(asked window, windows from ``begin`` to ``before`` that share an open place's token, which places of the asked one a similar span may hold), some windows at a time.

        A span of an asked window from s to e and of another from the places of its first to its last token share x tokens:
        similar where (100 + percent) x >= percent (both lengths), so the sum (100 + percent) x - percent (own place + other
        place) has to grow enough between them. That holds for tokens in step that don't repeat; a window with
        others may also hold what lies in a row of which ``percent`` are its tokens. On both sides the shared tokens
        reach over ``least`` places.
        """
        value, asker, first, last, times, of = places_of(flat, bounds, group)
        fresh = np.zeros(len(value), bool)
        fresh[of[open_ & (of >= 0)]] = True
        if not len(self.value) or not len(value):
            return
        found = np.minimum(np.searchsorted(self.value, value), len(self.value) - 1)
        a, b = (np.searchsorted(self.posting, found * (self.count + 1) + x[asker]) for x in (begin, before))
        b = np.where(self.value[found] == value, b, a)
        by = np.argsort(asker, kind="stable")  # each window's tokens together
        met = b > a
        may = 100 * np.bincount(asker, np.where(met, times, 0), minlength=len(group)) >= percent * least
        may &= np.bincount(asker[fresh & met], minlength=len(group)) > 0
        cuts = np.searchsorted(asker[by], np.arange(len(group) + 1))
        work = np.concatenate(([0], np.cumsum((b - a)[by])))[cuts]
        work = np.maximum(np.diff(work), before - begin)
        lengths = np.diff(bounds)
        local = np.empty(len(value), np.int64)
        local[by] = np.arange(len(by)) - cuts[asker[by]]
        repeats = np.bincount(asker[times > 1], minlength=len(group)) > 0
        once, owner = not repeats.any(), self.owner.astype(np.int32)
        turn = np.argsort(lengths, kind="stable")
        turn = turn[may[turn]]
        done = 0
        while done < len(turn):
            load = np.cumsum(work[turn[done:]])
            asks = turn[done : done + max(1, int(np.searchsorted(load, most, side="right")))]
            done += len(asks)
            # The postings of the tokens of these windows, and their sums by pair of windows.
            col = by[np.concatenate([np.arange(x, y) for x, y in zip(cuts[asks], cuts[asks + 1], strict=True)])]
            col = col[met[col]]
            n = b[col] - a[col]
            post = (np.repeat(a[col] - np.cumsum(n) + n, n) + np.arange(n.sum())).astype(np.int32)
            sizes = before[asks] - begin[asks]
            shift = np.zeros(len(group), np.int64)
            shift[asks] = np.cumsum(sizes) - sizes - begin[asks]
            pair = owner[post] + np.repeat(shift[asker[col]].astype(np.int32), n)
            total = int(sizes.sum())
            news = np.zeros(total, bool)
            news[pair[np.repeat(fresh[col], n)]] = True
            enough = news & (100 * np.bincount(pair, None if once else np.repeat(times[col], n), minlength=total) >= percent * least)
            use = enough[pair]
            post, col, pair = post[use], np.repeat(col, n)[use], pair[use]
            row = np.cumsum(enough) - 1
            pairs = np.flatnonzero(enough)
            span = []
            for x, y in ((first[col], last[col]), (self.place[post], self.last[post])):
                low, high = np.full(len(pairs), 1 << 40), np.full(len(pairs), -1)
                np.minimum.at(low, row[pair], x)
                np.maximum.at(high, row[pair], y)
                span.append(high - low)
            fine = np.minimum(*span) >= least - 1
            use = fine[row[pair]]
            post, col, pair = post[use], col[use], pair[use]
            pairs = pairs[fine]
            row = np.full(total, -1)
            row[pairs] = np.arange(len(pairs))
            row = row[pair]
            by_row = np.argsort(row, kind="stable")
            row, post, col = row[by_row], post[by_row], col[by_row]
            ask = np.repeat(asks, sizes)[pairs]
            who = pairs - shift[ask]
            k = 0
            while k < len(pairs):
                # Rows of as many places as the longest asked window, which is the last.
                many = max(1, int(np.count_nonzero((np.arange(k, len(pairs)) - k + 1) * lengths[ask[k:]] <= most)))
                rows = slice(k, k + many)
                f, t = np.searchsorted(row, (k, k + many))
                k += many
                whose = np.unique(ask[rows])
                of_ask = np.searchsorted(whose, ask[rows])
                wide = int(lengths[whose].max())
                inside = np.arange(wide)[None, :] < lengths[whose][:, None]
                tokens = np.full((len(whose), wide), wide)  # no token: the last column
                own = of[np.concatenate([np.arange(bounds[x], bounds[x + 1]) for x in whose])]
                tokens[inside] = np.where(own < 0, wide, local[own])
                again_ = np.zeros((len(whose), wide), bool)
                again_[inside] = (own >= 0) & (np.concatenate([np.arange(lengths[x]) for x in whose]) != first[own])
                place = np.full((len(of_ask), wide + 1), -1, np.int32)
                place[row[f:t] - rows.start, local[col[f:t]]] = self.place[post[f:t]]
                good, cover = self._may(np.take_along_axis(place, tokens[of_ask], axis=1), again_[of_ask], repeats[ask[rows]] | self.twice[who[rows]], least, percent)
                of_ask, some, cover = of_ask[good], who[rows][good], cover[good]
                edge = np.flatnonzero(np.concatenate(([True], of_ask[1:] != of_ask[:-1], [True]))) if len(of_ask) else of_ask
                for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    q = int(whose[of_ask[x]])
                    yield q, some[x:y], cover[x:y, : lengths[q]]

    @staticmethod
    def _may(place: np.ndarray, again_: np.ndarray, repeats: np.ndarray, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which rows, and which of their places, a similar span may hold: ``place`` has the other side's places, or -1."""
        has, gain, at = place >= 0, 100 + percent, np.arange(place.shape[1], dtype=np.int32)
        lag = at - least + 1  # the last place from which a span may begin
        sums = gain * np.cumsum(has, axis=1, dtype=np.int32) - percent * (at[None, :] + place)
        low = np.minimum.accumulate(np.where(has, sums, np.int32(1 << 30)), axis=1)
        high = np.where(has, sums, np.int32(-(1 << 30)))
        least_gain = 2 * percent - gain
        starts = np.where(lag >= 0, low[:, np.maximum(lag, 0)], np.int32(1 << 30))
        ends = high - starts >= least_gain
        good = ends.any(axis=1)
        cover = np.maximum.accumulate(np.where(ends, high, np.int32(-(1 << 30)))[:, ::-1], axis=1)[:, ::-1] - low >= least_gain
        last = np.maximum.accumulate(place, axis=1)
        loose = np.flatnonzero(~good & (repeats | (has[:, 1:] & (place[:, 1:] < last[:, :-1])).any(axis=1)))
        if len(loose):
            cost = np.where(has[loose], np.int32(100 - percent), np.where(again_[loose], np.int32(0), np.int32(-percent)))
            total = np.zeros((len(loose), len(at) + 1), np.int32)
            np.cumsum(cost, axis=1, out=total[:, 1:])
            cover[loose] = np.maximum.accumulate(total[:, ::-1], axis=1)[:, ::-1][:, 1:] >= np.minimum.accumulate(total, axis=1)[:, :-1]
            good[loose] = cover[loose].sum(axis=1) >= least
        return good, cover


def _hot_windows(least: int, percent: int, width: int):
    def ordered(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(where each asked window's key begins among the held ones in order, where its document does; these held ones: by keys, then documents, null ids first; each window's key as a small number).

        Of held windows of a key with the same tokens the first stands for all: what it doesn't cover, no other does.
        """
        both = pa.concat_tables([x.select(["key", "doc_id", "uid", "lo"]) for x in (left, right)])
        n = left.num_rows
        doc, uid, lo = (both.column(c).fill_null(0).to_numpy() for c in ("doc_id", "uid", "lo"))
        _, key = np.unique(both.column("key").to_numpy(), return_inverse=True)
        held = np.arange(len(key)) < n
        order = np.lexsort((lo, held, uid, doc, both.column("doc_id").is_valid().to_numpy(), key))
        tokens, keys, seen = left.column("tokens").to_pylist(), key.tolist(), set()
        for k in order[held[order]].tolist():
            held[k] = (own := (keys[k], tokens[k])) not in seen
            seen.add(own)
        before = np.empty(len(key), np.int64)
        before[order] = np.cumsum(held[order])
        windows = order[held[order]]
        return np.searchsorted(key[windows], key[n:]), before[n:], windows, key

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([])
        begin, before, windows, key = ordered(left, right)
        held, asked = left.take(pa.array(windows)), right
        group = key[: left.num_rows][windows], key[left.num_rows :]
        (flat, bounds), (own, cuts) = laid_out(held.column("tokens")), laid_out(asked.column("tokens"))
        open_, lows = np.ones(len(own), bool), asked.column("lo").to_pylist()
        for k, (spans, lo) in enumerate(zip(asked.column("spans").to_pylist(), lows, strict=True)):
            mine = open_[cuts[k] : cuts[k + 1]]
            for x in spans or []:
                mine[max(0, x["start"] - lo) : max(0, x["end"] - width + 1 - lo)] = False
        (docs, uids), (s_docs, s_lows) = (asked.column(c).to_pylist() for c in ("doc_id", "uid")), (held.column(c).to_pylist() for c in ("doc_id", "lo"))
        out = []
        for q, who, cover in Windows(flat, bounds, group[0]).covers(own, cuts, group[1], open_.copy(), begin, before, least, percent):
            mine, tokens, lo = open_[cuts[q] : cuts[q + 1]], own[cuts[q] : cuts[q + 1]], lows[q]
            fresh = np.ones(len(who), bool)
            while len(who):
                gain = np.where(fresh, np.count_nonzero(cover & mine, axis=1), 0)
                w = int(np.argmax(gain))
                if not gain[w]:
                    break
                fresh[w] = False
                h = int(who[w])
                for s, e, s2, e2, jaccard in joined_spans(tokens, flat[bounds[h] : bounds[h + 1]], least, percent):
                    if mine[s:e].any():
                        mine[s:e] = False
                        out.append((docs[q], uids[q], lo + s, lo + e + width - 1, s_docs[h], s_lows[h] + s2, s_lows[h] + e2 + width - 1, jaccard))
        return _found(out)

    return run


def document_key(doc_id, text):
    """A 64-bit key of a row: its id and whole text."""
    return F.xxhash64(doc_id.cast("long"), text.cast("string"))


def _shared_windows(met: DataFrame, least: int, min_hits: int) -> DataFrame:
    """(uid, s_uid) of texts whose shared windows under ``min_hits`` functions overlap by ``least`` on both sides."""
    few = met.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("w", "lo", "hi"))).alias("all"))
    pair = lambda x, i: F.transform(F.filter(F.slice("all", F.lit(1), i), lambda y: y["w"] < x["w"]), lambda y: F.struct(x["w"]["uid"].alias("uid"), y["w"]["uid"].alias("s_uid"), F.struct((F.col("key").bitwiseAND(7)).alias("f"), x["lo"].alias("lo"), x["hi"].alias("hi"), y["lo"].alias("lo2"), y["hi"].alias("hi2")).alias("x")))
    hits = few.select(F.explode(F.flatten(F.transform("all", pair))).alias("p")).select("p.*").groupBy("uid", "s_uid").agg(F.collect_list("x").alias("hits"))
    meet = lambda a, b: (F.least(a["hi"], b["hi"]) - F.greatest(a["lo"], b["lo"]) >= least) & (F.least(a["hi2"], b["hi2"]) - F.greatest(a["lo2"], b["lo2"]) >= least)
    enough = F.exists("hits", lambda a: F.size(F.array_distinct(F.transform(F.filter("hits", lambda b: meet(a, b)), lambda b: b["f"]))) >= min_hits)
    return hits.filter(enough).select("uid", "s_uid")


def repeated_passages(docs: DataFrame, words: int = 50, percent: int = 75, width: int = 5, functions: int = 6, min_hits: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, uid, start, end, source_id, source_start, source_end, jaccard: word spans [start, end) of ``doc_id`` that near-duplicate a passage of an earlier document.

    Passages have ``words`` or more words on both sides, begin and end with shared ``width``-word shingles, and have a
    similarity of ``percent`` or more between their sets of shingles (compared by 32 bits of their hashes); words may be
    changed, inserted or deleted. Earlier: smaller doc_id, null ids first; rows with equal id and text are one document
    (``uid`` tells rows with equal ids apart), and equal texts (by a 64-bit hash) are told as whole passages of the first.
    A document lists each source it meets, so spans may overlap; of a frequent passage that may be the first source only.
    Null and short texts have no passage; extra columns are left out; an empty table gives an empty one. ``functions``: 8 at
    most.
    """
    spark, least = docs.sparkSession, words - width + 1
    four = docs.select(F.col(doc_id).cast("long").alias("doc_id"), document_key(F.col(doc_id), F.col(text)).alias("uid"), F.xxhash64(F.col(text).cast("string")).alias("tid"), F.col(text).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(repeated_shingles(four, width, "text", "passage-repeats", hashes=text_shingles))
    rows = staged(four.mapInArrow(_rows(shared, least, percent, width, functions), ROWS), "passage-rows")
    # Of equal texts the first stands for all: the others are wholly its passage.
    first = rows.groupBy("tid").agg(F.min(F.struct("doc_id", "uid")).alias("f"))
    told = staged(rows.select("doc_id", "uid", "tid", "n").distinct().join(first.hint("merge"), "tid"), "passage-texts")
    copies = told.filter((F.col("uid") != F.col("f.uid")) & (F.col("n") >= words)).select("doc_id", "uid", F.lit(0).alias("start"), F.col("n").alias("end"), F.col("f.doc_id").alias("source_id"), F.lit(0).alias("source_start"), F.col("n").alias("source_end"), F.lit(1.0).alias("jaccard"))
    single = staged(rows.join(told.filter(F.col("uid") == F.col("f.uid")).select("uid").hint("merge"), "uid", "left_semi").dropDuplicates(["uid"]), "passage-first")
    discard(rows)
    x = F.explode(F.arrays_zip("keys", "lo", "hi")).alias("x")
    windows = single.select(F.struct("doc_id", "uid").alias("w"), x).select(F.col("x.keys").alias("key"), "w", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"))
    groups = windows.groupBy("key").agg(F.min("w").alias("a"), F.max("w").alias("z"), F.count(F.lit(1)).alias("m")).filter("a <> z").drop("z")
    met = staged(windows.join(groups.hint("merge"), "key"), "passage-windows")
    hot = met.filter(F.col("m") > FEW)
    star = hot.filter("w.uid <> a.uid").select(F.col("w.uid").alias("uid"), F.col("a.uid").alias("s_uid"))
    pairs = _shared_windows(met.filter(F.col("m") <= FEW), least, min_hits).union(star).distinct()
    side = single.select("uid", "doc_id", "tokens")
    whole = pairs.join(side.hint("merge"), "uid").join(side.select(F.col("uid").alias("s_uid"), F.col("doc_id").alias("s_doc"), F.col("tokens").alias("s_tokens")).hint("merge"), "s_uid")
    found = staged(whole.select("doc_id", "uid", "tokens", "s_doc", "s_tokens").mapInArrow(_verify(least, percent, width), FOUND), "passage-found")
    # What is open of the windows of hot keys.
    spans = found.groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    mine = hot.select("key", F.col("w.doc_id").alias("doc_id"), F.col("w.uid").alias("uid"), "lo", "hi", F.col("a.uid").alias("a")).join(spans.hint("merge"), "uid", "left")
    covered = F.exists("spans", lambda s: (s["start"] <= F.col("lo")) & (s["end"] >= F.col("hi") + width - 1))
    mine = mine.withColumn("open", (F.col("uid") != F.col("a")) & ~F.coalesce(covered, F.lit(False)))
    near = F.when(F.col("open"), F.filter("spans", lambda s: (s["start"] < F.col("hi")) & (s["end"] > F.col("lo"))))
    mine = mine.withColumn("spans", near).drop("a")
    tokens = F.sum((F.col("hi") - F.col("lo")).cast("long"))
    cut = mine.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.count_if("open").alias("o"), tokens.alias("mt"), F.sum(F.when(F.col("open"), F.col("hi") - F.col("lo")).cast("long")).alias("ot")).filter("o > 0")
    blocks = lambda n, t: F.ceil(F.greatest(F.col(n) / F.lit(BLOCK), F.col(t) / F.lit(BLOCK_TOKENS))).cast("int")
    cut = cut.select("key", blocks("m", "mt").alias("lb"), blocks("o", "ot").alias("rb"))
    held = mine.join(cut.hint("merge"), "key").join(single.select("uid", "tokens").hint("merge"), "uid")
    held = staged(held.select("key", "doc_id", "uid", "lo", "open", "spans", "lb", "rb", F.expr("substring(tokens, 4 * lo + 1, 4 * (hi - lo))").alias("tokens")), "passage-open")
    place = lambda of: F.pmod(F.xxhash64("uid", "lo"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    # Keys of one block each go together, about a block's windows and tokens a group.
    size = held.agg(F.count(F.lit(1)).alias("m"), F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0)).alias("t")).first()
    group = F.when((F.col("lb") == 1) & (F.col("rb") == 1), F.pmod(F.xxhash64("key"), F.lit(1 + max(size["m"] // BLOCK, size["t"] // (4 * BLOCK_TOKENS))))).otherwise(F.col("key")).alias("group")
    cols = ["key", "doc_id", "uid", "lo", "tokens"]
    left = held.select(group, place("lb").alias("p"), every("rb").alias("q"), *cols)
    right = held.filter("open").select(group, every("lb").alias("p"), place("rb").alias("q"), *cols, "spans")
    right = right.toDF(*right.columns)
    by = ["group", "p", "q"]
    more = staged(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_hot_windows(least, percent, width), FOUND).distinct(), "passage-more")
    discard(single, met, held)
    return found.unionByName(more).unionByName(copies)


_WORD = re.compile("[^ \t-\r]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, last = [], 0
    for s, e in sorted(spans):
        if at[e] > last:
            out.append(text[last : max(last, at[s])])
            last = at[e]
    return "".join([*out, text[last:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        spans = batch.column("spans").to_pylist()
        new = [t if not s else cut_words(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], names=["row", "text"])


def drop_repeated_passages(docs: DataFrame, passages: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the spans of ``passages`` cut from the texts; a document stays where its passage came first.

    Rows are found by id and text, so ids may be null or repeat; null texts stay null; all columns stay.
    """
    spans = passages.groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    kept = docs.select(document_key(F.col(doc_id), F.col(text)).alias("uid"), F.struct(*[x for c, x in zip(docs.columns, all_columns(docs), strict=True) if c != text]).alias("row"), F.col(text).alias("text"))
    kind = StructType([kept.schema["row"], StructField("text", StringType())])
    done = kept.join(spans.hint("merge"), "uid", "left").select("row", "text", "spans").mapInArrow(_cut, kind)
    return done.select(*[F.col("text").alias(text) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
