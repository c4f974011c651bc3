"""Piece lattices over many words at once.

A word's lattice has an edge for each vocabulary piece that ends at a position, and byte-fallback edges for
characters without a piece of their own. All words of a batch advance together, one character at a time; starts
whose string is no prefix of a piece are dropped, so the work follows the edges that exist.
"""

from __future__ import annotations

import functools
import heapq
import math

import numpy as np

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BITS = 19
#: Words above this many characters go one by one.
LONG = 48
NONE = -2


class Pieces:
    """A fixed vocabulary: pieces, scores, byte pieces and a hash table of all prefixes of pieces."""

    def __init__(self, pieces: list[str], scores: np.ndarray, byte_ids: np.ndarray | None, usable: np.ndarray):
        self.pieces, self.scores, self.byte_ids = pieces, scores, byte_ids
        self.score_list = scores.tolist()
        self.ids = {p: i for i, p in enumerate(pieces) if usable[i]}
        self.size = len(pieces)
        self.longest = max(map(len, self.ids), default=1)
        values: dict[str, int] = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                values.setdefault(p[:k], -1)
            values[p] = i
        self.values = values
        self.keys = np.zeros(1 << _BITS, np.uint64)
        self.vals = np.full(1 << _BITS, NONE, np.int32)
        for p, i in values.items():
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    h = (h + np.uint64(ord(c) + 1)) * _BASE
                slot = int((h * _MIX) >> np.uint64(64 - _BITS))
            while self.vals[slot] != NONE:
                slot = (slot + 1) & ((1 << _BITS) - 1)
            self.keys[slot], self.vals[slot] = h, i

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id, -1 for a mere prefix, NONE otherwise."""
        slot = ((h * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)
        out = self.vals[slot]
        open_ = np.flatnonzero((self.keys[slot] != h) & (out != NONE))
        out[open_] = NONE
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << _BITS) - 1)
            v = self.vals[slot]
            hit = self.keys[slot] == h[open_]
            out[open_[hit]] = v[hit]
            go = ~hit & (v != NONE)
            open_, slot = open_[go], slot[go]
        return out

    def fallback_ids(self, char: str) -> list[int]:
        """Ids for a character that is no piece: its UTF-8 bytes' pieces, or the unknown piece."""
        if self.byte_ids is None:
            return [0]
        return [int(self.byte_ids[b]) for b in char.encode("utf-8", "surrogatepass")]


@functools.lru_cache(maxsize=4)
def load_pieces(model_path: str) -> Pieces:
    """The pieces of a SentencePiece model file and their natural log probabilities.

    A unigram model has these itself. A BPE model has merge ranks, which are no probabilities: rank r counts as Zipf's
    1 / (r + 100), byte pieces as the last rank, over their sum.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    byte = [sp.is_byte(i) for i in range(n)]
    byte_ids = None
    if any(byte):
        byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(pieces):
            if byte[i]:
                byte_ids[int(p[1:-1], 16)] = i
    usable = np.array([not (byte[i] or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)])
    scores = np.array([sp.get_score(i) for i in range(n)])
    if (scores[usable] == np.round(scores[usable])).all():
        counted = usable | np.array(byte)
        rank = np.where(usable, -scores, -scores[usable].min(initial=0))
        scores = -np.log(rank + 100) - np.log((1 / (rank[counted] + 100)).sum())
    return Pieces(pieces, scores, byte_ids, usable)


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (longest first), lengths in that order, and code points by position."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lens, kind="stable")
    lens = lens[order]
    flat = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
    top = int(lens[0]) if len(lens) else 0
    grid = np.zeros((len(words), top), np.uint32)
    grid[np.arange(top)[None, :] < lens[:, None]] = flat
    return order, lens, np.ascontiguousarray(grid.T)


def edges(v: Pieces, lens: np.ndarray, grid: np.ndarray):
    """For each end position: (end, [(start, rows, piece ids)], rows and characters without a piece of length 1)."""
    alive: list[tuple[int, np.ndarray, np.ndarray]] = []
    with np.errstate(over="ignore"):
        for i in range(grid.shape[0]):
            n = int(np.searchsorted(-lens, -i, side="left"))  # words longer than i
            alive.append((i, np.arange(n), np.zeros(n, np.uint64)))
            found, kept, miss = [], [], None
            for start, rows, h in alive:
                if len(rows) and rows[-1] >= n:
                    m = int(np.searchsorted(rows, n))
                    rows, h = rows[:m], h[:m]
                if not len(rows):
                    continue
                h = (h + (grid[i][rows].astype(np.uint64) + np.uint64(1))) * _BASE
                val = v.find(h)
                hit = val >= 0
                if start == i:
                    miss = rows[~hit]
                if hit.any():
                    found.append((start, rows[hit], val[hit]))
                on = val != NONE
                if i + 1 - start < v.longest and on.any():
                    kept.append((start, rows[on], h[on]))
            alive = kept
            yield i + 1, found, miss


def _fallback(v: Pieces, chars: np.ndarray, weights: np.ndarray) -> np.ndarray:
    u, inv = np.unique(chars, return_inverse=True)
    return np.array([weights[v.fallback_ids(chr(c))].sum(axis=0) for c in u])[inv]


def log_marginals(v: Pieces, words: list[str], logp: np.ndarray) -> np.ndarray:
    """ln of the sum over all segmentations of the product of piece probabilities.

    ``logp``: pieces x columns, natural logs. Returns words x columns; the empty word has 0.
    """
    out = np.zeros((len(words), logp.shape[1]))
    short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG]
    for i in (i for i, w in enumerate(words) if len(w) > LONG):
        out[i] = _long_marginal(v, words[i], logp)
    for a in range(0, len(short), 16_000):
        part = short[a : a + 16_000]
        order, lens, grid = _matrix([words[i] for i in part])
        alpha = np.full((grid.shape[0] + 1, len(part), logp.shape[1]), -np.inf)
        alpha[0] = 0
        for end, found, miss in edges(v, lens, grid):
            to = alpha[end]
            if miss is not None and len(miss):
                to[miss] = alpha[end - 1][miss] + _fallback(v, grid[end - 1][miss], logp)
            for start, rows, ids in found:
                to[rows] = np.logaddexp(to[rows], alpha[start][rows] + logp[ids])
        out[np.array(part)[order]] = alpha[lens, np.arange(len(part))]
    return out


def _scalar_edges(v: Pieces, word: str):
    """(end, [(start, id or None, fallback ids)]) for one word."""
    get = v.values.get
    ends: list[list] = [[] for _ in range(len(word) + 1)]
    for i in range(len(word)):
        if get(word[i], NONE) < 0:
            ends[i + 1].append((i, v.fallback_ids(word[i])))
        for k in range(1, min(v.longest, len(word) - i) + 1):
            x = get(word[i : i + k], NONE)
            if x == NONE:
                break
            if x >= 0:
                ends[i + k].append((i, [x]))
    return ends


def _long_marginal(v: Pieces, word: str, logp: np.ndarray) -> np.ndarray:
    """A ring of the last positions only, so memory doesn't grow with the word."""
    get, cols = v.values.get, logp.shape[1]
    size = v.longest + 1
    ring = np.full((size, cols), -np.inf)
    ring[0] = 0
    for i in range(len(word)):
        here = ring[i % size].copy()
        ring[i % size] = -np.inf
        if get(word[i], NONE) < 0:
            ring[(i + 1) % size] = np.logaddexp(ring[(i + 1) % size], here + logp[v.fallback_ids(word[i])].sum(axis=0))
        for k in range(1, min(v.longest, len(word) - i) + 1):
            x = get(word[i : i + k], NONE)
            if x == NONE:
                break
            if x >= 0:
                ring[(i + k) % size] = np.logaddexp(ring[(i + k) % size], here + logp[x])
    return ring[len(word) % size]


def best_two(v: Pieces, words: list[str]) -> list[tuple[float, float, bytes]]:
    """Of each word: best score, how much the second best loses (inf if there is none), best ids as uint32 bytes.

    Equal scores go to the longer last piece.
    """
    out: list = [(0.0, math.inf, b"")] * len(words)
    for i in (i for i, w in enumerate(words) if len(w) > LONG):
        out[i] = _long_best_two(v, words[i])
    short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG]
    for a in range(0, len(short), 16_000):
        part = short[a : a + 16_000]
        order, lens, grid = _matrix([words[i] for i in part])
        n, top = len(part), grid.shape[0]
        b1, b2 = np.full((top + 1, n), -np.inf), np.full((top + 1, n), -np.inf)
        back, piece = np.zeros((top + 1, n), np.int8), np.full((top + 1, n), -1, np.int32)
        b1[0] = 0
        for end, found, miss in edges(v, lens, grid):
            if miss is not None and len(miss):
                s = _fallback(v, grid[end - 1][miss], v.scores)
                b1[end][miss], b2[end][miss] = b1[end - 1][miss] + s, b2[end - 1][miss] + s
                back[end][miss] = 1
            for start, rows, ids in found:
                s = v.scores[ids]
                c1, c2 = b1[start][rows] + s, b2[start][rows] + s
                o1, o2 = b1[end][rows], b2[end][rows]
                b2[end][rows] = np.maximum(np.minimum(o1, c1), np.maximum(o2, c2))
                won = c1 > o1
                to = rows[won]
                b1[end][to] = c1[won]
                back[end][to] = end - start
                piece[end][to] = ids[won]
        last = np.arange(n)
        s1, s2 = b1[lens, last], b2[lens, last]
        at, rows, ids = lens.copy(), [], []
        while (live := np.flatnonzero(at > 0)).size:
            rows.append(live)
            own = piece[at[live], live].astype(np.int64)
            ids.append(np.where(own >= 0, own, -2 - grid[at[live] - 1, live].astype(np.int64)))
            at[live] -= back[at[live], live]
        rows, ids = np.concatenate(rows)[::-1], np.concatenate(ids)[::-1]
        order2 = np.argsort(rows, kind="stable")
        ids, ends = ids[order2], np.cumsum(np.bincount(rows, minlength=n)) * 4
        raw, spelled = ids.astype("<u4").tobytes(), np.unique(rows[order2][ids < 0])
        start = 0
        for to, one, two, end in zip(np.array(part)[order].tolist(), s1.tolist(), s2.tolist(), ends.tolist(), strict=True):
            out[to] = (one, one - two, raw[start:end])
            start = end
        for r in spelled.tolist():  # words with characters that aren't pieces
            own = [y for x in ids[(ends[r - 1] // 4 if r else 0) : ends[r] // 4].tolist() for y in ([x] if x >= 0 else v.fallback_ids(chr(-2 - x)))]
            out[part[order[r]]] = (*out[part[order[r]]][:2], np.array(own, np.uint32).tobytes())
    return out


def _long_best_two(v: Pieces, word: str) -> tuple[float, float, bytes]:
    sc = v.score_list
    b1, b2 = [0.0] + [-math.inf] * len(word), [-math.inf] * (len(word) + 1)
    back: list = [None] * (len(word) + 1)
    for end, into in enumerate(_scalar_edges(v, word)):
        for start, ids in sorted(into, key=lambda e: e[0]):
            s = sum(sc[x] for x in ids)
            c1, c2 = b1[start] + s, b2[start] + s
            b2[end] = max(min(b1[end], c1), b2[end], c2)
            if c1 > b1[end]:
                b1[end], back[end] = c1, (start, ids)
    ids, at = [], len(word)
    while at:
        at, piece = back[at]
        ids.extend(reversed(piece))
    return b1[-1], b1[-1] - b2[-1], np.array(ids[::-1], np.uint32).tobytes()


def n_best(v: Pieces, word: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations, best first.

    A forward Viterbi pass gives the exact score of the best path from the start to each position; A* runs
    backwards from the end with it as heuristic, so finished paths leave the queue in order of score.
    """
    if not word:
        return [(0.0, [])]
    sc = v.score_list
    into = _scalar_edges(v, word)
    best = [0.0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = max(best[s] + sum(sc[x] for x in ids) for s, ids in into[end])
    heap = [(-best[-1], len(word), 0, 0.0, None)]  # of equal scores the path nearest to its end goes on
    out, tick = [], 1
    while heap and len(out) < n:
        rank, at, _, done, tail = heapq.heappop(heap)
        if at == 0:
            ids, node = [], tail
            while node:
                ids.extend(node[0])
                node = node[1]
            out.append((-rank, ids))
            continue
        for start, ids in into[at]:
            g = done + sum(sc[x] for x in ids)
            heapq.heappush(heap, (-(g + best[start]), start, tick, g, (ids, tail)))
            tick += 1
    return out


def _long_expected(v: Pieces, word: str, weight: float, logp: np.ndarray, out: np.ndarray) -> None:
    """``expected_counts`` of one word: forward sums of every position, then backward over the edges from each."""
    get, n, lp = v.values.get, len(word), logp.tolist()

    def edges_from(i: int):
        if get(word[i], NONE) < 0:
            ids = v.fallback_ids(word[i])
            yield i + 1, ids, sum(lp[x] for x in ids)
        for k in range(1, min(v.longest, n - i) + 1):
            x = get(word[i : i + k], NONE)
            if x == NONE:
                break
            if x >= 0:
                yield i + k, [x], lp[x]

    alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    alpha[0], beta[n] = 0, 0
    for i in range(n):
        for end, _, cost in edges_from(i):
            alpha[end] = np.logaddexp(alpha[end], alpha[i] + cost)
    for i in range(n - 1, -1, -1):
        for end, ids, cost in edges_from(i):
            through = cost + beta[end]
            beta[i] = np.logaddexp(beta[i], through)
            np.add.at(out, ids, weight * math.exp(alpha[i] + through - alpha[n]))


def expected_counts(v: Pieces, words: list[str], weights: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, each word ``weights`` times (forward-backward).

    ``logp``: one natural log probability a piece.
    """
    out = np.zeros(v.size)
    for i in (i for i, w in enumerate(words) if len(w) > LONG):
        _long_expected(v, words[i], float(weights[i]), logp, out)
    short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG]
    for a in range(0, len(short), 16_000):
        part = short[a : a + 16_000]
        order, lens, grid = _matrix([words[i] for i in part])
        top, n, w = grid.shape[0], len(part), weights[np.array(part)[order]]
        alpha, beta = np.full((top + 1, n), -np.inf), np.full((top + 1, n), -np.inf)
        alpha[0] = 0
        steps = []
        for end, found, miss in edges(v, lens, grid):
            cost = None
            if miss is not None and len(miss):
                cost = _fallback(v, grid[end - 1][miss], logp)
                alpha[end][miss] = alpha[end - 1][miss] + cost
            for start, rows, ids in found:
                alpha[end][rows] = np.logaddexp(alpha[end][rows], alpha[start][rows] + logp[ids])
            steps.append((end, found, miss, cost))
        total = alpha[lens, np.arange(n)]
        beta[lens, np.arange(n)] = 0
        for end, found, miss, cost in reversed(steps):
            if cost is not None:
                use = w[miss] * np.exp(alpha[end - 1][miss] + cost + beta[end][miss] - total[miss])
                u, inv = np.unique(grid[end - 1][miss], return_inverse=True)
                for c, x in zip(u, np.bincount(inv, weights=use), strict=True):
                    np.add.at(out, v.fallback_ids(chr(c)), x)
                beta[end - 1][miss] = np.logaddexp(beta[end - 1][miss], beta[end][miss] + cost)
            for start, rows, ids in found:
                through = logp[ids] + beta[end][rows]
                out += np.bincount(ids, weights=w[rows] * np.exp(alpha[start][rows] + through - total[rows]), minlength=v.size)
                beta[start][rows] = np.logaddexp(beta[start][rows], through)
    return out
