"""Source divergence audit: how the term distributions of a language's sources differ from each other and from the language's.

Terms are counted in tasks by length buckets: terms of up to eight bytes are packed into one uint64 word, of up to
sixteen into two; words are radix-sorted by 16-bit digits and equal runs counted. Longer terms are byte-sorted in
buckets of doubling width. What a task has counted meets by language and term, so a frequent term is one row a task and
source. All that follows is exact integer arithmetic on the counts of kept terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gives_back, staged

#: Byte -> lower-cased byte of a term, 0 for bytes outside terms: ASCII letters and all of UTF-8 beyond ASCII are inside.
_TERM = np.zeros(256, np.uint8)
_TERM[97:123] = np.arange(97, 123)
_TERM[65:91] = np.arange(97, 123)
_TERM[128:] = np.arange(128, 256)

#: Tokens of which a task holds the packed words before it sorts and counts them.
TOKENS = 2_000_000


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of texts that stand one after another in ``data``: the lower-cased bytes, each term's start, length and text number."""
    low = _TERM[data]
    inside = low > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # no term crosses from one text to the next
    start = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    return low, start, end - start, np.searchsorted(offsets, start, side="right") - 1


def packed(low: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Each term as so many big-endian uint64 words, zeros behind its end."""
    width = 8 * words
    held = np.lib.stride_tricks.sliding_window_view(np.append(low, np.zeros(width, np.uint8)), width)[start]
    held[np.arange(width) >= length[:, None]] = 0
    return list(held.view(">u8").astype(np.uint64).T)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by the words, the first one most: least significant 16-bit digits first; digits that are all alike are passed over."""
    order = np.arange(len(words[0]))
    for w in reversed(words):
        for shift in range(0, 64, 16):
            digit = (w >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(new_term: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens ordered by term, group and document: the first token of each (term, group), its tokens and its documents."""
    n = len(group)
    changed = lambda x: np.append(True, x[1:] != x[:-1])
    first = np.flatnonzero(new_term | changed(group))
    new_doc = new_term | changed(doc)
    return first, np.diff(np.append(first, n)), np.add.reduceat(new_doc.astype(np.int64), first)


def unpacked(words: list[np.ndarray]) -> np.ndarray:
    """The bytes of packed terms."""
    return np.stack(words, axis=1).astype(">u8").view(f"S{8 * len(words)}").ravel()


class TermCounter:
    """Tokens by length bucket, with their group and document, until they are counted."""

    def __init__(self) -> None:
        self.short: dict[int, list] = {1: [], 2: []}
        self.long: dict[int, list] = {}
        self.tokens = self.docs = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """Texts with the number of each one's group."""
        low, start, length, text = runs(data, offsets)
        bucket = np.where(length <= 8, 1, np.where(length <= 16, 2, 0))
        for words, held in self.short.items():
            at = np.flatnonzero(bucket == words)
            held.append((*packed(low, start[at], length[at], words), group[text[at]], self.docs + text[at]))
        at = np.flatnonzero(bucket == 0)
        width = 1 << np.ceil(np.log2(np.maximum(length[at], 1))).astype(np.int64)
        for w in np.unique(width).tolist():
            own = at[width == w]
            terms = np.array([low[s : s + n].tobytes() for s, n in zip(start[own].tolist(), length[own].tolist(), strict=True)], f"S{w}")
            self.long.setdefault(w, []).append((terms, group[text[own]], self.docs + text[own]))
        self.docs += len(offsets) - 1
        # A long term counts as the tokens whose words would take its room, a text as one.
        self.tokens += len(start) + int(width.sum()) // 16 + len(offsets) - 1

    def counted(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(terms, group, tokens, documents) of each bucket; the counter is empty afterwards."""
        for held in self.short.values():
            *words, group, doc = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0),) * 3
            held.clear()
            if len(doc):
                order = np.lexsort((doc, group))
                order = order[radix_order([w[order] for w in words])]
                words, group, doc = [w[order] for w in words], group[order], doc[order]
                new = np.append(True, np.any([w[1:] != w[:-1] for w in words], axis=0))
                first, n, df = run_counts(new, group, doc)
                yield unpacked([w[first] for w in words]), group[first], n, df
        for held in self.long.values():
            terms, group, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((doc, group))
            order = order[np.argsort(terms[order], kind="stable")]
            terms, group, doc = terms[order], group[order], doc[order]
            first, n, df = run_counts(np.append(True, terms[1:] != terms[:-1]), group, doc)
            yield terms[first], group[first], n, df
        self.long, self.tokens, self.docs = {}, 0, 0


@gives_back
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> lang, source, term, n, df of a task's part; each group also once with an empty term."""
    names = ["lang", "source", "term", "n", "df"]
    groups: dict[tuple[str, str], int] = {}
    counter = TermCounter()

    def rows(langs: list, sources: list, terms: pa.Array, n: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), terms.cast(pa.binary()), pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=names)

    def flush() -> Iterator[pa.RecordBatch]:
        pairs = np.array([*groups, ("", "")], dtype=object)
        for terms, group, n, df in counter.counted():
            for i in range(0, len(terms), 100_000):
                own = pairs[group[i : i + 100_000]]
                yield rows(own[:, 0].tolist(), own[:, 1].tolist(), pa.array(terms[i : i + 100_000].tolist(), pa.binary()), n[i : i + 100_000], df[i : i + 100_000])
        none = np.zeros(len(groups), np.int64)
        yield rows([g[0] for g in groups], [g[1] for g in groups], pa.array([b""] * len(groups), pa.binary()), none, none)
        groups.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        group = np.array([groups.setdefault(g, len(groups)) for g in zip(langs, sources, strict=True)], np.int64)
        text = batch.column("text")
        wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
        offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        start = 0
        while start < len(text):  # pieces of a few megabytes, one text at least
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + 4_000_000, side="right")) - 1)
            counter.add(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], group[start:end])
            start = end
            if counter.tokens >= TOKENS:
                yield from flush()
                group = np.array([groups.setdefault(g, len(groups)) for g in zip(langs, sources, strict=True)], np.int64)
    yield from flush()


def term_counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, source, term, n: occurrences of the terms that ``least`` or more documents of the language hold, and each group once with an empty term."""
    text = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = text.mapInArrow(_count, "lang string, source string, term binary, n long, df long")
    # One shuffle: sums by language, source and term, and over a language's sources, find their rows together.
    by = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = by.withColumn("df", F.sum("df").over(Window.partitionBy("lang", "term"))).filter((F.col("df") >= least) | (F.length("term") == 0))
    return kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n")


def _deltas(table: pa.Table) -> pa.Table:
    """lang, source, other, delta: sums over the chunk's terms of |p - q| less |p0 - q0|, for all pairs of its sources."""
    sources, who = np.unique(np.array(table.column("source").to_pylist(), dtype=object), return_inverse=True)
    base = np.zeros(len(sources), np.int64)
    base[who] = table.column("p0").to_numpy()
    held = table.column("term").is_valid().to_numpy()
    who, p = who[held], table.column("p").filter(pa.array(held)).to_numpy()
    _, term = np.unique(np.array(table.column("term").drop_null().to_pylist(), dtype=object), return_inverse=True)
    width = int(term.max(initial=-1)) + 1
    size, out = 64, []
    order = np.argsort(who, kind="stable")
    first = np.searchsorted(who[order], np.arange(0, len(sources) + size, size))
    dense = lambda own, start, n, terms: _filled(base[start : start + n], terms, who[own] - start, term[own], p[own])
    for i in range(0, len(sources), size):
        for j in range(i, len(sources), size):
            a, b = (order[first[k // size] : first[k // size + 1]] for k in (i, j))
            m, n = min(size, len(sources) - i), min(size, len(sources) - j)
            x, y = (dense(own, start, k, width) for own, start, k in ((a, i, m), (b, j, n)))
            d = np.stack([np.abs(row - y).sum(axis=1) for row in x]) - width * np.abs(base[i : i + m, None] - base[None, j : j + n])
            s, t = np.nonzero(np.ones_like(d))
            both = [(s + i, t + j)] + ([(t + j, s + i)] if j > i else [])
            out += [(sources[u], sources[v], d[s, t]) for u, v in both]
    u, v, d = (np.concatenate(x) for x in zip(*out, strict=True))
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": [lang] * len(d), "source": u.tolist(), "other": v.tolist(), "delta": pa.array(d, pa.int64())}).filter(pa.array(u != v))


def _filled(base: np.ndarray, terms: int, row: np.ndarray, col: np.ndarray, value: np.ndarray) -> np.ndarray:
    x = np.repeat(base[:, None], terms, axis=1)
    x[row, col] = value
    return x


def divergence_audit(docs: DataFrame, least: int = 30, pseudo: int = 5, unit: int = 1_000_000_000, top: int = 50, chunk: int = 20_000) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each (lang, source) group apart.

    A language keeps the terms that ``least`` of its documents hold. With V of them and N of a group's tokens among
    them, a term of the group has p = 1 + unit * (count + pseudo) div (N + pseudo * V), the language's alike. Part
    ``pair`` has for each other source of the language the sum of |p - q| over all kept terms, part ``term`` the
    ``top`` terms of the group by p less the language's, where positive; ranks by falling value, then by item in UTF-8.

    Nulls in text, lang and source count as empty strings, empty texts make their group occur; repeated rows count each,
    texts of any length are counted whole, extra columns are left out, an empty table gives an empty one. Sources meet in
    chunks of about ``chunk`` (term, source) counts; the pairs of a language's sources are the result itself.
    """
    kept = staged(term_counts(docs, least), "divergence-terms")
    terms, groups = kept.filter("term <> ''"), kept.filter("term = ''").select("lang", "source")
    by_lang = terms.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("held"))
    share = lambda n, total: F.lit(1).cast("long") + F.expr(f"cast({unit} as decimal(20, 0)) * cast({n} + {pseudo} as decimal(18, 0)) div cast({total} + {pseudo} * v as decimal(20, 0))")
    about = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    about = about.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"), F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("held", F.lit(0)).alias("held"))
    # Without kept terms there is nothing to divide by, nor anything to sum.
    about = staged(about.withColumn("p0", F.when(F.col("v") > 0, share("0", "group_n")).otherwise(F.lit(0).cast("long"))), "divergence-groups")

    p = terms.join(about, ["lang", "source"]).withColumn("p", share("n", "group_n"))
    chunks = about.groupBy("lang").agg(F.ceil(F.sum("held") / (F.lit(chunk) + F.count(F.lit(1)))).alias("chunks"))
    cut = p.join(chunks, "lang").select("lang", "source", "term", "p", "p0", F.pmod(F.xxhash64("term"), F.col("chunks")).alias("chunk"))
    # A chunk knows every source of its language: one without any of its terms has p0 for them.
    every = about.join(chunks.filter("chunks > 0"), "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "p0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    deltas = cut.unionByName(every).groupBy("lang", "chunk").applyInArrow(lambda t: _deltas(t), "lang string, source string, other string, delta long")
    deltas = deltas.groupBy("lang", "source", "other").agg(F.sum("delta").alias("delta"))
    others = about.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    pairs = about.select("lang", "source", "p0", "v").join(others, "lang").filter("source <> other").join(deltas, ["lang", "source", "other"], "left")
    pair = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), (F.col("v") * F.abs(F.col("p0") - F.col("q0")) + F.coalesce("delta", F.lit(0))).alias("value"))

    q = by_lang.join(langs, "lang").select("lang", "term", share("n", "lang_n").alias("q"))
    more = p.select("lang", "source", "term", "p").join(q, ["lang", "term"]).filter("p > q")
    term = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pair).unionByName(ranked(term).filter(F.col("rank") <= top))
