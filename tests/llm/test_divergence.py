"""The source divergence audit against a plain version, and its counting by length buckets."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipyard.llm import divergence_audit as D
from clipyard.llm.divergence_audit import TermCounter, divergence_audit, packed, radix_order, runs, unpacked

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def by_hand(docs, least):
    docs = [tuple(x or "" for x in d) for d in docs]
    df, count, groups = collections.defaultdict(set), collections.Counter(), {(lang, source) for lang, source, _ in docs}
    for i, (lang, source, text) in enumerate(docs):
        for t in TERM.findall(text.translate(LOWER)):
            df[lang, t].add(i)
            count[lang, source, t] += 1
    kept = collections.defaultdict(list)
    for (lang, t), x in df.items():
        if len(x) >= least:
            kept[lang].append(t)
    out = []

    def shares(lang, counts):
        n, v = sum(counts.values()), len(kept[lang])
        return {t: 1 + 10**9 * (c + 5) // (n + 5 * v) for t, c in counts.items()}

    for lang, source in groups:
        mine = {t: count[lang, source, t] for t in kept[lang]}
        p = shares(lang, mine)
        pairs = []
        for other in {s for x, s in groups if x == lang and s != source}:
            q = shares(lang, {t: count[lang, other, t] for t in kept[lang]})
            pairs.append((-sum(abs(p[t] - q[t]) for t in kept[lang]), other.encode(), other))
        q = shares(lang, {t: sum(count[lang, s, t] for x, s in groups if x == lang) for t in kept[lang]})
        terms = [(q[t] - p[t], t.encode(), t) for t in kept[lang] if mine[t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:50])):
            out += [(lang, source, part, item, -value, i) for i, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


def got(df, least, **more):
    rows = divergence_audit(df, least, **more).select("lang", "source", "part", "item", "value", "rank").collect()
    return sorted(tuple(r) for r in rows)


def corpus(sources, n, seed=0):
    r = random.Random(seed)
    words = ["a", "Wave", "ünïcode", "eightchr", "ninechars", "sixteencharacter", "seventeencharacte", "x" * 40, "É" * 30, "ta1no", "日本"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    texts = [" ".join(r.choice(words[: 10 + 4 * (s % 20)]) + r.choice(["", ".", "-", "\t"]) for _ in range(30)) for s in range(n)]
    return [(r.choice(["en", "fr", None]), f"s{i % sources}" if i % 7 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("sources,chunk", [(4, 20_000), (4, 3), (150, 500)])
def test_audit_is_brute_force(spark, sources, chunk):
    docs = corpus(sources, 600)
    df = spark.createDataFrame([(*d, 7, 7) for d in docs], "lang string, source string, text string, term long, n long").repartition(5)
    assert got(df, 30, chunk=chunk) == by_hand(docs, 30)


def test_odd_rows(spark):
    docs = [(None, None, None), ("en", "a", ""), ("en", "b", "Tie tie"), ("en", "b", "Tie tie"), ("en", "c", "tie other Other"), ("en", "c", "other"), ("fr", "only", "mot mot"), ("xx", "a", "1 2 3"), ("xx", "b", None), ("en", "long", "y" * 100_000 + " " + "y" * 100_000)]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    for least in (1, 2, 30):
        assert got(df, least) == by_hand(docs, least)
    assert got(df.limit(0), 1) == []


def test_small_buckets_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(D, "TOKENS", 50)
    docs = [(lang or "", source or "", text) for lang, source, text in corpus(5, 60, 3)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), d, strict=True)) for d in docs])
    n, df = collections.Counter(), collections.Counter()
    for part in D._count(iter([batch.slice(0, 20), batch.slice(20)])):
        for r in part.to_pylist():
            n[r["lang"], r["source"], r["term"].decode()] += r["n"]
            df[r["lang"], r["source"], r["term"].decode()] += r["df"]
    want_n, want_df = collections.Counter(), collections.Counter()
    for lang, source, text in docs:
        found = TERM.findall(text.translate(LOWER))
        want_n.update((lang, source, t) for t in found)
        want_df.update((lang, source, t) for t in set(found))
    assert +n == want_n and +df == want_df


def test_words_and_radix_order():
    texts = ["ab", "", "cé Zz", "zz日"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    low, start, length, text = runs(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert [low[s : s + n].tobytes().decode() for s, n in zip(start, length, strict=True)] == ["ab", "cé", "zz", "zz日"]
    assert text.tolist() == [0, 2, 2, 3]
    assert unpacked(packed(low, start, length, 1)).tolist() == [b"ab", "cé".encode(), b"zz", "zz日".encode()]
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(40), rng.integers(0, 2**63, 500).astype(np.uint64) >> np.uint64(50)]
    assert radix_order(words).tolist() == np.lexsort((words[1], words[0])).tolist()
    assert list(TermCounter().counted()) == []
