"""The training-data operators against plain versions, and on nulls, ties, repeated rows, long texts and odd columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clipyard.llm import jaccard_join, lattice
from clipyard.llm.common import Memo, crc_bucket, heaviest, space_units
from clipyard.llm.exact_dedup import exact_dedup
from clipyard.llm.jaccard_join import Index, jaccard_components, prefix_length, prefixes
from clipyard.llm.language_id import fit_language_model, identify_language
from clipyard.llm.lm_scoring import lm_scores
from clipyard.llm.packing import best_fit_pack, plan, unit_ids
from clipyard.llm.quality import fit_additive, quality_scores
from clipyard.llm.sentencepiece_codec import combine, decode, encode_n_best, text_units
from clipyard.llm.shingles import WordHashes, connected_components, from_planes, packed_counts, shingle_arrays, shingle_hashes, word_hashes, words_of
from clipyard.llm.substring_dedup import compact_windows, cut_words, drop_repeated_passages, repeated_passages
from clipyard.llm.token_counts import token_counts
from clipyard.llm.top_k import ImpactIndex, top_k

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = "the a of wave sound tone clip onset frame rate band mel city rain car door bird voice drum hall".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


ODD = [None, "", " ", "\t\n", "a", "A  b\tc", "a b c", "日本 ñ é\u0085x", "<|endoftext|> a <|endoftext|>", "x" * 30_000, "▁ mark", "..!! 12", "a b\x0bc", " a b c "]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a repeated row, a repeated id, a null id, a long text, and columns named as inner ones are."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(4, "a"), (4, "another text"), (None, "a b c"), (50, prose(1, 25_000))]
    cols = "row rid gid digit uid key keys n tokens cell label text_sha256 start".split()
    df = spark.createDataFrame([(i, t, *[7] * len(cols)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} long" for c in cols))
    return df.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies of chained distance, passages that documents share, and plain documents."""
    r = random.Random(5)
    texts = [prose(100 + i, r.randrange(3, 200)) for i in range(60)]
    base = prose(7, 120).split()
    for k in range(12):
        w = base[:]
        for j in range(k):
            w[(j * 9) % 120] = "new" + str(j)
        texts.append(" ".join(w))
    texts += [texts[3], texts[3].upper(), texts[3].replace(" ", "\n "), texts[3] + "  "]
    passage = prose(9, 64)
    texts += [prose(200 + i, 70) + " " + passage + " " + prose(300 + i, 90) for i in range(6)]
    texts += ["a b c d", "a  b c D", "a b c", ""]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def whole(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


# 1


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[50:60] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None]), (902, [float("nan")] * 16), (903, [float("inf")] * 16), (904, []), (905, [1.0, 2.0]), (None, [0.0] * 16), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("block", F.lit(2))
    for block, query_block in ((1 << 20, 1 << 16), (600, 48)):
        got = collections.defaultdict(list)
        for r in top_k(df, df.filter("vec_id % 50 = 0"), block=block, query_block=query_block).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        q = np.floor(256 * x.astype(float)).astype(int)
        for i in range(0, 300, 50):
            s = q @ q[i]
            assert got[i] == [(j, s[j]) for j in sorted((j for j in range(300) if j != i), key=lambda j: (-s[j], j))[:5]]
        assert set(got) == set(range(0, 300, 50))
    assert top_k(df.limit(0), df.limit(0)).count() == 0
    assert top_k(df, df.filter("vec_id = 905")).count() == 0


def test_segments_stop_with_proof():
    rng = np.random.default_rng(3)
    for x in (np.floor(rng.standard_t(2, size=(900, 8)) * 100).astype(np.int64), np.floor(rng.normal(size=(900, 64)) * 256).astype(np.int64)):
        index, early = ImpactIndex(x), 0
        assert index.segments.sum() == (x != 0).sum() == len(index.value)
        for r in range(40):
            ids, score, read = index.best(x[r], np.arange(len(x)), r, 5)
            early += read < len(index.value)
            s = x @ x[r]
            want = sorted((j for j in range(len(x)) if j != r), key=lambda j: (-s[j], j))[:5]
            assert ids.tolist() == want and score.tolist() == [s[j] for j in want]
            assert set(want) <= set(index.members(x[r], np.array([r]), 5)[0].tolist())
        assert early > (30 if x.shape[1] == 64 else 0)
    zero = ImpactIndex(np.zeros((7, 3), np.int64))
    assert zero.best(np.zeros(3, np.int64), np.arange(7), 0, 5)[0].tolist() == [1, 2, 3, 4, 5]


def test_most_queries_stop_before_the_last_segments(spark):
    """On the test vectors: how many queries are proven before all postings are read."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.floor(256 * np.stack(rows["embedding"]).astype(float)).astype(np.int64)
    index, ids = ImpactIndex(x), rows["vec_id"].to_numpy()
    read = np.array([index.best(x[i], ids, ids[i], 5)[2] for i in np.flatnonzero(ids % 50 == 0)])
    assert (read < len(index.value)).mean() > 0.9


def test_a_repeated_id_with_other_vectors_hides_no_neighbour():
    """The query's own rows are all nearer than the k others."""
    x, ids = np.ones((200, 4), np.int64) * 100, np.arange(200)
    x[:4] += np.arange(1, 5)[:, None]
    ids[:4] = 0
    assert ImpactIndex(x).best(x[0], ids, 0, 5)[0].tolist() == [4, 5, 6, 7, 8]
    x[4:] -= np.arange(196)[:, None] % 90
    assert ImpactIndex(x).best(x[0], ids, 0, 5)[0].tolist() == [4, 94, 184, 5, 95]


# 2


def segmentations(v, word):
    if not word:
        return [(0.0, [])]
    out = []
    for k in range(1, len(word) + 1):
        ids = [v.ids[word[:k]]] if word[:k] in v.ids else v.fallback_ids(word[0]) if k == 1 else None
        if ids:
            out += [(sum(v.scores[i] for i in ids) + s, ids + rest) for s, rest in segmentations(v, word[k:])]
    return out


def test_n_best_is_brute_force():
    v = lattice.load_pieces(MODEL)
    for w in ["▁hello", "▁the", "▁日本x", "▁", "▁▁▁a", "ab\nc"]:
        every = sorted((s for s, _ in segmentations(v, w)), reverse=True)
        got = lattice.n_best(v, w, 6)
        assert np.allclose([s for s, _ in got], every[:6])
        assert len({tuple(i) for _, i in got}) == len(got)
        (one, loss, ids), long = lattice.best_two(v, [w])[0], lattice._long_best_two(v, w)
        assert np.isclose(one, every[0]) and (np.isclose(one - loss, every[1]) if len(every) > 1 else loss == math.inf) and ids == long[2]


def test_text_n_best_combines_units():
    v = lattice.load_pieces(MODEL)
    units = text_units("low tone bad")
    every = sorted((sum(s for s, _ in c) for c in itertools.product(*[segmentations(v, u) for u in units])), reverse=True)
    lists = [(i, lattice.n_best(v, u, 4)) for i, u in enumerate(units)]
    top = sum(x[0][0] for _, x in lists)
    assert np.allclose([top - loss for loss, _ in combine(lists, 4)], every[:4])


def test_encode_and_decode(spark, odd, none):
    got = encode_n_best(odd, MODEL)
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
    assert all([x.score for x in r.nbest] == sorted((x.score for x in r.nbest), reverse=True) for r in rows)
    assert [len(r.ids) for r in rows if r.doc_id == 1] == [0]
    back = sorted(map(str, ((r.doc_id, r.decoded) for r in decode(got.select("doc_id", "ids"), MODEL).collect())))
    assert back == sorted(str((r.doc_id, (r.text or "").replace("▁", " "))) for r in odd.collect())
    assert encode_n_best(none, MODEL).count() == 0


# 3


def check_dedup(df, got):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = collections.defaultdict(list)
    for r in df.collect():
        groups[norm(r.text)].append(r.doc_id)
    assert sum(r.kept for r in got) == len(groups) and len(got) == df.count()
    want = sorted(str((i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest())) for t, ids in groups.items() for i in ids)
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want


@pytest.mark.parametrize("width", [1, 64])
def test_exact_dedup(spark, odd, none, corpus, width):
    check_dedup(corpus, exact_dedup(corpus, first_digit=width, last_digit=64 if width == 1 else 1 << 20).collect())
    if width > 1:
        check_dedup(odd, exact_dedup(odd).collect())
        assert exact_dedup(none).count() == 0
        kept = exact_dedup(odd, keep_rows=True).filter("kept").select("row.*")
        assert kept.columns == odd.columns and kept.filter("length(text) = 30000").count() == 1


# 4


def test_language_id_learns_and_handles_odd_texts(spark, odd, none):
    v = lattice.load_pieces(MODEL)
    en, de = "the rain falls on the city and the street is wet".split(), "der regen fällt auf die stadt und die straße ist nass".split()
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(w) for _ in range(12)), lang) for i in range(60) for lang, w in (("en", en), ("de", de))]
    df = spark.createDataFrame([*rows, (999, "x", None), (998, None, "en")], "doc_id long, text string, lang string")
    lm = fit_language_model(df, MODEL)
    assert lm.langs == ["de", "en"] and np.allclose(np.exp(lm.logp).sum(axis=0), 1)
    got = {r.row: (r.lang_pred, r.score) for r in identify_language(spark.createDataFrame([(1, "the city AND the rain"), (2, "die stadt und der regen"), (3, None), (4, "12 !!"), (5, "")], "doc_id long, text string"), lm, MODEL).collect()}
    assert (got[1][0], got[2][0]) == ("en", "de") and got[3] == got[4] == got[5] == ("und", 0.0) and 0.5 < got[1][1] <= 1
    brute = np.logaddexp.reduce([sum(lm.logp[i] for i in ids) for _, ids in segmentations(v, "▁stadt")])
    assert np.allclose(lattice.log_marginals(v, ["▁stadt"], lm.logp)[0], brute)
    assert identify_language(odd, lm, MODEL, carry=F.struct(*odd.columns)).count() == odd.count()
    assert {r.lang_pred for r in identify_language(odd, fit_language_model(none, MODEL), MODEL).collect()} == {"und"}


def test_language_posterior_is_brute_force(spark):
    """Of whole texts: every segmentation of every word under each language, and the languages' shares."""
    docs = spark.createDataFrame([(1, "the rain", "en"), (2, "the city rain the", "en"), (3, "la ville pluie", "fr"), (4, None, None)], "doc_id long, text string, lang string")
    m, v = fit_language_model(docs, MODEL), lattice.load_pieces(MODEL)
    assert m.langs == ["en", "fr"] and np.allclose(np.exp(m.prior), [2 / 3, 1 / 3]) and np.allclose(np.exp(m.logp).sum(axis=0), 1)
    asked = spark.createDataFrame([(9, "rain la"), (10, "pluie é"), (11, "½ ² ³ 12"), (12, "the")], "doc_id long, text string")
    got = {r.row: (r.lang_pred, r.score) for r in identify_language(asked, m, MODEL).collect()}
    assert got.pop(11) == ("und", 0.0)
    for r in asked.filter("doc_id <> 11").collect():
        x = m.prior + sum(np.log(sum(np.exp(m.logp[ids].sum(axis=0)) for _, ids in segmentations(v, "▁" + w))) for w in r.text.split())
        post = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        assert got[r.doc_id][0] == m.langs[int(post.argmax())] and math.isclose(got[r.doc_id][1], post.max(), rel_tol=1e-9)


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = crc_bucket(F.col("doc_id"), 4) == 2
    lm = fit_language_model(docs.filter(~out), MODEL)
    got = identify_language(docs.filter(out), lm, MODEL, carry=F.struct("lang")).select("row.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


# 5


def test_units_rebuild_texts_and_counts_are_the_librarys(spark, odd, none, corpus):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    for t in [*filter(None, ODD), "a  b \n c", " a", "a ", "a \tb"]:
        assert "".join(space_units(t)) == t
    for df in (odd, corpus):
        got = sorted(map(str, token_counts(df, BPE).collect()))
        want = [(r.doc_id, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect()]
        assert got == sorted(f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit={n > 1024})" for i, b, n in want)
    assert token_counts(none, BPE).count() == 0


# 6


def links_by_hand(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def find(x):
        return x if up[x] == x else find(up[x])

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("few", "block"), [(16, 2000), (1, 2000), (1, 2), (3, 3)])
def test_jaccard_components(spark, corpus, monkeypatch, few, block):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(corpus).collect()}
    assert got == links_by_hand(whole(corpus))


def test_hot_families_of_near_copies(spark, monkeypatch):
    """Sixty copies of one text with other words changed in each: most pairs are too far apart, some chains link."""
    monkeypatch.setattr(jaccard_join, "FEW", 4)
    rng, base, texts = random.Random(5), prose(900, 60).split(), {}
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(60), i % 5):
            own[k] = f"new{rng.randrange(4)}"
        texts[i] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()} == links_by_hand(texts)


def test_jaccard_components_odd(odd, none):
    got = jaccard_components(odd).collect()
    assert len(got) == odd.count() and {r.component_id for r in got if r.doc_id in (0, 1, 2, 3)} == {0, 1, 2, 3}
    assert {r.component_id for r in got if r.doc_id in (5, 6, 12, 13, None)} == {5}
    assert jaccard_components(none).count() == 0


def test_prefixes_meet_and_index_counts():
    assert [prefix_length(n, 75) for n in (1, 4, 5, 100)] == [1, 2, 2, 26]
    rng = np.random.default_rng(0)
    sets = [np.sort(rng.choice(1 << 40, 50, replace=False)).astype(np.uint64) for _ in range(8)]
    sets += [np.unique(np.concatenate((sets[0][k:], rng.integers(1 << 50, 1 << 51, k, dtype=np.uint64)))) for k in range(1, 20)]
    index, first = Index(sets), [prefixes(s, 0, np.zeros(len(s), np.uint32), 3, 75) for s in sets]
    for a, s in enumerate(sets):
        want = [len(np.intersect1d(s, x)) for x in sets]
        assert index.shared(s).tolist() == want
        for b, both in enumerate(want):
            if 100 * both >= 75 * (len(s) + len(sets[b]) - both):
                assert all(len(np.intersect1d(x, y)) for x, y in zip(first[a], first[b], strict=True))


def test_shingles_of_many_texts_and_counts():
    texts, known = ["a b c d e f g", "", "x y", "a b c d e", " ", "q"], WordHashes()
    flat, bounds, _, _ = shingle_arrays([words_of(t) for t in texts], known, 5)
    for i, t in enumerate(texts):
        assert flat[bounds[i] : bounds[i + 1]].tolist() == shingle_hashes(word_hashes(words_of(t), known)).tolist()
    got = packed_counts([flat, flat[:2]], 6).to_pylist()
    seen = collections.Counter((int(h) >> 58, (int(h) >> 26) & 0xFFFFFFFF) for h in [*flat, *flat[:2]])
    back = {}
    for r in got:
        n = {v: 1 for v in from_planes(r["data"]).tolist()}
        at, times = np.frombuffer(r["more"], "<u4").reshape(2, -1)
        n |= {list(n)[i]: int(k) for i, k in zip(at, times, strict=True)}
        back |= {(r["bucket"], v): k for v, k in n.items()}
    assert back == seen


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, j) for j in range(101, 140)] + [(200, 201), (201, 200), (5, 5)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


# 7


def test_packing_is_gapless_whole_and_tight(spark, odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    for df, cap in ((odd, 2048), (odd, 64)):
        got = best_fit_pack(df, BPE, RANKS, capacity=cap).collect()
        seqs = collections.defaultdict(list)
        for r in got:
            seqs[r.sequence_id].append((r.offset, r.length))
        for s in seqs.values():
            at = 0
            for off, n in sorted(s):
                assert off == at
                at += n
            assert at <= cap
        assert len(seqs) <= 1.25 * math.ceil(sum(r.length for r in got) / cap) + 1
        want = []
        for r in df.collect():
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
            first = len(ids) % cap or cap
            cuts = [0, *range(first, len(ids) + 1, cap)]
            want += [(r.doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(itertools.pairwise(cuts))]
        assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    assert best_fit_pack(none, BPE, RANKS).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_plan_keeps_every_constraint(score):
    r = random.Random(1)
    counts = dict(collections.Counter(r.randrange(1, 101) for _ in range(3000)))
    for docs, cost in ((100, 1e4), (3, 1e4), (100, 4000.0)):
        if score == "dot" and cost < 1e4:
            counts = {k: v for k, v in counts.items() if k * k <= cost}
        bins = plan({k: v for k, v in counts.items() if k * k <= cost}, 100, docs, cost, score=score)
        got = collections.Counter()
        for n, held in bins:
            assert sum(k * m for k, m in held) <= 100 and sum(m for _, m in held) <= docs and sum(k * k * m for k, m in held) <= cost
            for k, m in held:
                got[k] += n * m
        assert got == {k: v for k, v in counts.items() if k * k <= cost}


def test_two_libraries_give_equal_ids():
    units = [u for i in range(5) for u in space_units(prose(i, 50))] + [" Éaux", " <|endoftext|>x", " 日本", "a\n\nb", " don't", "  "]
    assert unit_ids(BPE, RANKS, units) == unit_ids(BPE, None, units)


# 8


def cartesian(v, least):
    """The nodes of width ``least`` or more, cut to ``least`` - 1 around the minimum."""
    out, todo = set(), [(0, len(v))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        c = a + int(np.argmin(v[a:b]))
        out.add((max(a, c - least + 1), c, min(b, c + least) - 1))
        todo += [(a, c), (c + 1, b)]
    return out


def test_compact_windows_are_the_cartesian_trees():
    rng = np.random.default_rng(4)
    for n, least in ((200, 10), (300, 46), (9, 10), (10, 10), (64, 1)):
        v = rng.permutation(n).astype(np.uint64)
        assert set(zip(*(x.tolist() for x in compact_windows(v, least)), strict=True)) == cartesian(v, least)


def test_shared_passages_are_found_and_clean_documents_left(spark, corpus):
    texts = whole(corpus)
    words = {i: t.lower().split() for i, t in texts.items()}
    seen, need = {}, collections.defaultdict(set)
    for i in sorted(words):
        runs = {tuple(words[i][p : p + 50]): p for p in range(len(words[i]) - 49)}
        for r, p in runs.items():
            if seen.setdefault(r, i) < i:
                need[i].update(range(p, p + 50))
    got = repeated_passages(corpus).collect()
    cover = collections.defaultdict(set)
    for r in got:
        assert r.source_id < r.doc_id and r.end - r.start >= 50 and r.jaccard >= 0.75
        cover[r.doc_id].update(range(r.start, r.end))
        a, b = words[r.doc_id][r.start : r.end], words[r.source_id][r.source_start : r.source_start + r.end - r.start]
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) / len(x | y) >= 0.749
    assert all(need[i] <= cover[i] for i in need) and len(need) >= 10
    assert not {i for i in cover if i < 60}
    cut = whole(drop_repeated_passages(corpus, repeated_passages(corpus)))
    assert all(cut[i] == texts[i] for i in range(60)) and len(cut) == len(texts)
    shared = [i for i in texts if prose(9, 64) in texts[i]]
    assert prose(9, 64) in cut[shared[0]] and all(prose(9, 64) not in cut[i] and cut[i] for i in shared[1:])


def planted(seed: int, kind: str, n: int, edits: int) -> tuple[str, str, int]:
    """Two documents around a passage of ``n`` words, edited in the second, and where it begins there."""
    r = random.Random(seed)
    fresh = lambda k, tag: [f"{tag}{seed}x{r.randrange(10**9)}" for _ in range(k)]
    passage = fresh(n, "p")
    other = passage[:]
    for k in range(edits):
        at = (k + 1) * n // (edits + 1)
        if kind == "change":
            other[at] = f"new{seed}x{k}"
        elif kind == "insert":
            other.insert(at + k, f"new{seed}x{k}")
        elif kind == "delete":
            del other[at - k]
    if kind == "swap":
        other = passage[n // 2 :] + passage[: n // 2]
    before = fresh(r.randrange(20, 60), "c")
    return " ".join(fresh(40, "a") + passage + fresh(40, "b")), " ".join(before + other + fresh(30, "d")), len(before)


# Kind, words, edits: each of a Jaccard similarity of 0.75 or more on shingles.
CHANGED = [("change", 50, 1)], [("change", 80, 2), ("change", 140, 3), ("change", 400, 9)]
SHIFTED = [("insert", 50, 1), ("insert", 60, 1), ("insert", 98, 2), ("delete", 60, 1), ("delete", 100, 2), ("swap", 80, 0)]


def planted_recall(spark, kinds, each=12) -> float:
    """Share of planted passages of which the later document's words are found, but for the four at each end."""
    rows, want = [], {}
    for k, (kind, n, edits) in enumerate(kinds):
        for t in range(each):
            a, b, at = planted(1000 * k + t, kind, n, edits)
            rows += [(len(rows), a), (len(rows) + 1, b)]
            want[len(rows) - 1] = set(range(at + 4, at + n - 6))
    cover = collections.defaultdict(set)
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.source_id == r.doc_id - 1
        cover[r.doc_id].update(range(r.start, r.end))
    return sum(w <= cover[i] for i, w in want.items()) / len(want)


def test_passages_with_changed_words_are_found(spark):
    assert planted_recall(spark, [x for part in CHANGED for x in part]) == 1


def test_passages_with_words_inserted_deleted_or_swapped_are_found(spark):
    assert planted_recall(spark, SHIFTED) == 1


def test_passages_around_a_hot_line_are_found(spark):
    """A line of 45 words in many documents; two in the middle share a passage around it, exact or with a word changed."""
    r = random.Random(3)
    fresh = lambda k: [f"w{r.randrange(10**9)}" for _ in range(k)]
    line, rows, want = fresh(45), [], {}
    for i in range(60):
        left, right = fresh(5), fresh(6)
        for _ in range(2):
            rows.append(fresh(30) + left + line + right + fresh(30))
        rows[-1][40] = rows[-1][40] if i % 2 else "changed"
        want[len(rows) - 1] = set(range(30 if i % 2 else 41, 82))
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")).collect()
    cover = collections.defaultdict(set)
    for x in got:
        cover[x.doc_id].update(range(x.start, x.end))
    assert all(w <= cover[i] for i, w in want.items())


def test_passages_odd(odd, none):
    assert repeated_passages(odd).count() == 0 and repeated_passages(none).count() == 0
    assert drop_repeated_passages(odd, repeated_passages(odd)).columns == odd.columns
    assert cut_words("a b  c d", [(1, 3), (2, 3)]) == "a d" and cut_words(" a\nb", [(0, 2)]) == " "


# 9


def test_quality_model(spark, odd, none):
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 20))
    y = ((x[:, 0] > 0.3) & ((x[:, 1] > 0.5) == (x[:, 2] > 0.5))).astype(float)
    m = fit_additive(x[:3000], y[:3000])
    assert ((m.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9 and (1, 2) in m.pairs
    assert fit_additive(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (4, 0)], "doc_id long, quality int")
    got = quality_scores(odd, labels, F.lit(False)).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality_scores(none, labels, F.lit(False)).count() == 0
    assert {r.score for r in quality_scores(odd, labels.limit(0), F.lit(False)).collect()} == {0.5}


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_scores(docs, labels, crc_bucket(F.col("doc_id"), 4) == 2).filter("held_out").join(labels, "doc_id").toPandas()
    good, bad = got[got.quality == 1]["score"], got[got.quality == 0]["score"]
    auc = np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])
    assert auc > 0.85


# 10


def test_lm_scores_base_and_marginals(spark, odd, none):
    df = spark.createDataFrame([(i, prose(i % 17, 3 + i % 40)) for i in range(120)] + [(500, None), (501, "Unseen wörd"), (None, "the a")], "doc_id long, text string")
    out = crc_bucket(F.col("doc_id"), 7) == 2
    for common in (1 << 18, 5):
        got = lm_scores(df, out, MODEL, common_words=common).collect()
        count, tokens = collections.Counter(), lambda t: [*(t or "").encode().lower().split(), None]
        for r in df.collect():
            if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 != 2:
                count.update(tokens(r.text))
        n, v = count.total(), len(count)
        by = collections.defaultdict(list)
        for r in df.collect():
            by[r.doc_id].append(r.text)
        for r in got:
            w = tokens(by[r.doc_id][0])
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
            assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9) and r.score < 0
    first = {r.doc_id: r.score for r in lm_scores(df, out, MODEL, common_words=1 << 18).collect()}
    assert all(math.isclose(first[r.doc_id], r.score, rel_tol=1e-9) for r in got)
    assert lm_scores(odd, F.lit(False), MODEL).count() == odd.count() and lm_scores(none, F.lit(False), MODEL).count() == 0
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in lm_scores(odd, F.lit(True), MODEL).collect())


def test_lm_scores_are_the_lattices(spark):
    """The score of whole texts from plain EM rounds over the training words and all segmentations."""
    texts = {i: prose(i, 2 + i % 5) for i in range(30)} | {77: None, 78: "x" * 60 + " unseen"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scores(df, crc_bucket(F.col("doc_id"), 7) == 2, MODEL, em_rounds=2, strength=50.0).collect()}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    words = collections.Counter(w for t in train for w in (t or "").split())
    v = lattice.load_pieces(MODEL)
    use = np.zeros(v.size, bool)
    use[[*v.ids.values(), *v.byte_ids]] = True
    prior = np.where(use, np.exp(v.scores), 0)
    prior /= prior.sum()
    counts = np.zeros(v.size)
    for _ in range(3):
        mass = counts + 50.0 * prior
        total = mass.sum() + len(train) + 1
        with np.errstate(divide="ignore"):
            logp = np.log(mass / total)
        last = counts
        counts = lattice.expected_counts(v, ["▁" + w for w in words], np.array(list(words.values()), float), logp)
    end = (len(train) + 1) / (last.sum() + 51.0 + len(train))
    for i, t in texts.items():
        want = lattice.log_marginals(v, ["▁" + w for w in (t or "").split()], logp.reshape(-1, 1)).sum() / math.log(10) + math.log10(end)
        assert math.isclose(got[i], want, rel_tol=1e-9)


def test_long_words_train_on_all_segmentations(monkeypatch):
    v = lattice.load_pieces(MODEL)
    logp = np.log(np.random.default_rng(2).dirichlet(np.ones(v.size)))
    words, weights = ["▁rainfall" * 3, "▁日a\nb", "▁x"], np.array([2.0, 1.0, 3.0])
    short = lattice.expected_counts(v, words, weights, logp)
    monkeypatch.setattr(lattice, "LONG", 1)
    assert np.allclose(lattice.expected_counts(v, words, weights, logp), short)


def test_expected_counts_are_brute_force():
    v = lattice.load_pieces(MODEL)
    logp = np.log(np.random.default_rng(0).dirichlet(np.ones(v.size)))
    words, weights = ["▁rain", "▁日a", "x\ny"], np.array([2.0, 1.0, 3.0])
    want = np.zeros(v.size)
    for w, k in zip(words, weights, strict=True):
        paths = [(ids, math.exp(sum(logp[i] for i in ids))) for _, ids in segmentations(v, w)]
        for ids, p in paths:
            np.add.at(want, ids, k * p / sum(q for _, q in paths))
    assert np.allclose(lattice.expected_counts(v, words, weights, logp), want)


def test_long_words_agree_with_short_ones(monkeypatch):
    v = lattice.load_pieces(MODEL)
    logp = np.log(np.random.default_rng(0).dirichlet(np.ones(v.size), 2).T)
    words = ["▁" + "rainfall" * 5, "▁ab\ncdé"]
    short, two = lattice.log_marginals(v, words, logp), lattice.best_two(v, words)
    monkeypatch.setattr(lattice, "LONG", 2)
    assert np.allclose(lattice.log_marginals(v, words, logp), short) and lattice.best_two(v, words) == two


def test_memo_and_heaviest(spark):
    calls = []
    m = Memo(lambda xs: [calls.append(x) or x * 2 for x in xs], limit=3)
    for part in (["a", "b"], ["b", "c", "d"], ["a", "e", "f"]):
        m.fill([part])
        assert all(m[x] == x * 2 for x in part)
    df = spark.range(1, 2000).withColumnRenamed("id", "n")
    got = [r.n for r in heaviest(df, "n", 100).collect()]
    assert 0 < len(got) <= 100 and min(got) == 2000 - len(got)


# 8: passages with repeated phrases, and reordered ones side by side


def found_share(spark, pairs) -> float:
    """Share of (first text, second text, first word, last word of the passage in the second) of which the words are found, but for four at each end."""
    rows, cover = [(2 * k + side, pair[side]) for k, pair in enumerate(pairs) for side in (0, 1)], collections.defaultdict(set)
    for x in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert x.source_id == x.doc_id - 1
        cover[x.doc_id].update(range(x.start, x.end))
    return sum(set(range(s + 4, e - 4)) <= cover[2 * k + 1] for k, (_, _, s, e) in enumerate(pairs)) / len(pairs)


def test_equal_passages_with_repeated_phrases_are_found(spark):
    r = random.Random(11)
    fresh = lambda k: [f"w{r.randrange(10**9)}" for _ in range(k)]
    pairs = []
    for t in range(40):
        phrase, words = fresh(r.choice([2, 5, 7])), []
        for _ in range(8):
            words += phrase + fresh(r.choice([0, 1, 3]))
        words = (words + fresh(64))[:64] if t % 2 else (phrase * 40)[:64]
        around = [fresh(20) + (phrase * r.choice([0, 1, 3]) + fresh(3)) * r.choice([0, 2]) for _ in range(4)]
        at = len(around[2])
        pairs.append((" ".join(around[0] + words + around[1]), " ".join(around[2] + words + around[3]), at, at + 64))
    assert found_share(spark, pairs) == 1


def test_reordered_passages_side_by_side_are_found(spark):
    r = random.Random(12)
    fresh = lambda k: [f"w{r.randrange(10**9)}" for _ in range(k)]
    first, both = [], []
    for t in range(20):
        p, q = fresh(80), fresh(80)
        p2, q2 = p[40:] + p[:40], q[40:] + q[:40]
        between = fresh(90 if t % 2 else 0)
        first.append((" ".join(fresh(30) + p + q + fresh(30)), " ".join(fresh(25) + p2 + between + q2 + fresh(10)), 25, 105))
        both.append((first[-1][0], first[-1][1], 105 + len(between), 185 + len(between)))
    assert found_share(spark, first) == 1 and found_share(spark, both) == 1


def test_equal_runs_are_brute_force():
    """Every equal run of ``least`` tokens is among those found or covered by others of that length; all found are equal and the longest."""
    from clipyard.llm.substring_dedup import equal_runs

    r = np.random.default_rng(5)
    for case in range(60):
        few = [2, 3, 8, 40][case % 4]
        motif = r.integers(0, few, 30)
        parts = lambda: np.concatenate([motif if r.random() < 0.6 else r.integers(0, 60, r.integers(1, 12)) for _ in range(12)])
        a, b = parts() + 1, parts() + 1
        least = 20
        i, j, n = equal_runs(a, b, least)
        for s, s2, k in zip(i, j, n, strict=True):
            assert (a[s : s + k] == b[s2 : s2 + k]).all()
        cover = np.zeros(len(a), bool)
        for s, k in zip(i, n, strict=True):
            if k >= least:
                cover[s : s + k] = True
        for d in range(-len(a), len(b)):
            run = 0
            for s in range(max(0, -d), min(len(a), len(b) - d) + 1):
                same = s < min(len(a), len(b) - d) and a[s] == b[s + d]
                if same:
                    run += 1
                else:
                    assert run < least or cover[s - run : s].all()
                    run = 0


def test_decode_odd(spark):
    df = spark.createDataFrame([(1, "Hello wave", "x"), (2, None, "y"), (2, None, "y")], "doc_id long, text string, decoded string")
    coded = encode_n_best(df.drop("decoded"), MODEL).select("doc_id", F.col("ids").cast("array<int>").alias("ids"), F.lit("old").alias("decoded"), F.lit(1).alias("a.b"))
    got = decode(coded.withColumn("ids", F.when(F.col("doc_id") == 1, F.col("ids"))), MODEL)
    assert sorted((r["doc_id"], r["decoded"], r["a.b"]) for r in got.collect()) == [(1, "Hello wave", 1), (2, "", 1), (2, "", 1)]
    assert decode(coded.limit(0), MODEL).count() == 0


def test_whole_texts_n_best_are_brute_force(spark):
    """Ids and scores of the four best segmentations of whole texts, against all of them."""
    v = lattice.load_pieces(MODEL)
    texts = ["low tone", "a ab", "x yz é", "bad  cab", ""]
    rows = {r.doc_id: r for r in encode_n_best(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL, 4).collect()}
    for i, t in enumerate(texts):
        units = text_units(t)
        every = sorted(((sum(s for s, _ in c), [ids for _, ids in c]) for c in itertools.product(*[segmentations(v, u) for u in units])), key=lambda x: -x[0])
        got = rows[i]
        assert np.allclose([x.score for x in got.nbest], [s for s, _ in every[:4]])
        score_of = {tuple(itertools.chain(*ids)): s for s, ids in every}
        assert np.isclose(score_of[tuple(got.ids)], every[0][0])
        best, seen = None, set()
        for x in got.nbest:  # each is the best with some units changed, and scores what it says
            if best is None:
                best = [list(lattice.n_best(v, u, 1)[0][1]) for u in units]
                assert [p for u in best for p in u] == list(got.ids) and not x.edits
            parts = [list(u) for u in best]
            for e in x.edits:
                parts[e.unit] = list(e.ids)
            ids = tuple(p for u in parts for p in u)
            assert np.isclose(score_of[ids], x.score)
            seen.add(ids)
        assert len(seen) == len(got.nbest)


def test_additive_scores_are_a_plain_loop():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6))
    x[:50, 2] = 0
    y = ((x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(size=900) * 0.3) > 0).astype(float)
    m = fit_additive(x, y)
    for row, got in zip(x[:200], m.score(x[:200]), strict=True):
        z = m.intercept
        for j, (edges, table) in enumerate(zip(m.edges, m.tables, strict=True)):
            z += table[sum(e <= row[j] for e in edges)]
        for (a, b), table in zip(m.pairs, m.pair_tables, strict=True):
            z += table[sum(e <= row[a] for e in m.pair_edges[a])][sum(e <= row[b] for e in m.pair_edges[b])]
        assert math.isclose(got, 1 / (1 + math.exp(-max(-30, min(30, z)))), rel_tol=1e-9)


# 8: the work of hot keys, and hashes of whole columns


def hot_tables(windows) -> tuple[pa.Table, pa.Table]:
    """Windows (key, doc_id, tokens, whether open) as the two sides of a hot key's block."""
    row = lambda k, d, t: {"key": k, "doc_id": d, "uid": d, "lo": 0, "tokens": np.array(t, np.uint32).tobytes()}
    kinds = [("key", pa.int64()), ("doc_id", pa.int64()), ("uid", pa.int64()), ("lo", pa.int32()), ("tokens", pa.binary())]
    spans = ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return pa.Table.from_pylist([row(k, d, t) for k, d, t, _ in windows], pa.schema(kinds)), pa.Table.from_pylist([row(k, d, t) | {"spans": None} for k, d, t, o in windows if o], pa.schema([*kinds, spans]))


def test_hot_windows_that_share_too_short_a_stretch_are_not_verified(monkeypatch):
    """40 tokens in a row are three quarters of 46 places, but no span from shared to shared token reaches 46."""
    from clipyard.llm import substring_dedup

    calls, real = [], substring_dedup.joined_spans
    monkeypatch.setattr(substring_dedup, "joined_spans", lambda *x: calls.append(x) or real(*x))
    shared, fresh = list(range(1000, 1040)), iter(range(5000, 9000))
    some = lambda n: [next(fresh) for _ in range(n)]
    twice = next(fresh)
    left, right = hot_tables([(8, 1, [twice, *some(9), *shared, *some(9), twice], False)] + [(8, d, some(10) + shared + some(10), True) for d in (2, 3)])
    assert substring_dedup._hot_windows(46, 75, 5)((), left, right).num_rows == 0 and not calls
    long = list(range(1000, 1046))
    left, right = hot_tables([(8, d, some(10) + long + some(10), d > 1) for d in (1, 2)])
    assert substring_dedup._hot_windows(46, 75, 5)((), left, right).num_rows == 1 and len(calls) == 1


def test_hot_windows_of_many_keys_together_are_those_of_each_alone(monkeypatch):
    from clipyard.llm.substring_dedup import Windows, _hot_windows

    r, windows = random.Random(4), []
    for key in range(12):
        base = [r.randrange(1, 10**9) for _ in range(90)]
        for doc in range(8):
            own = base[r.randrange(20) : 90 - r.randrange(20)]
            for _ in range(r.choice([0, 1, 2, 30])):
                own[r.randrange(len(own))] = r.choice([0, base[0], r.randrange(1, 10**9)])
            windows.append((key, None if doc == 3 else doc, own[30:] + own[:30] if doc == 5 else own, doc > 0))
    run = _hot_windows(46, 75, 5)
    found = lambda rows: sorted((tuple(x.values()) for x in rows), key=str)
    fix = lambda ws: [t.set_column(2, "uid", pa.array([zlib.crc32(x) for x in t.column("tokens").to_pylist()], pa.int64())) for t in hot_tables(ws)]
    alone = [x for k in range(12) for x in run((), *fix([w for w in windows if w[0] == k])).to_pylist()]
    assert found(run((), *fix(windows)).to_pylist()) == found(alone) and len(alone) > 40
    most = Windows.covers
    monkeypatch.setattr(Windows, "covers", lambda *x: most(*x, most=300))
    small = run((), *fix(windows)).to_pylist()
    assert {(x["uid"], p) for x in small for p in range(x["start"], x["end"])} == {(x["uid"], p) for x in alone for p in range(x["start"], x["end"])}


def test_column_shingles_are_those_of_words():
    """Equal where those of single words are, in the same order, however a column is cut."""
    from clipyard.llm.shingles import TextShingles

    texts = ["a b c d e f g", "", None, "x y", "A B c D e", " ", "q", "é ü\tß \r\nx", "no space end", "end", " lead a b c d e", "a b c d e "]
    for column in (pa.array(texts), pa.array(texts).slice(3, 6), pa.array(["", None]), pa.array([], pa.string())):
        want, bounds, _, _ = shingle_arrays([words_of(t) for t in column.to_pylist()], WordHashes(), 5)
        for limit in (1, 10, 10**6):
            parts = list(TextShingles(5).parts(column, limit))
            assert [n for _, _, _, b in parts for n in np.diff(b).tolist()] == np.diff(bounds).tolist()
            got = [h for _, _, flat, _ in parts for h in flat.tolist()]
            assert len(got) == len(want) and len(set(zip(got, want.tolist(), strict=True))) == len(set(got)) == len(set(want.tolist()))
