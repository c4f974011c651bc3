"""The pipeline's stages one by one, against what each should keep."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clipyard.llm.common import staged

DATA = "/root/testdata/sf0.001"
ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, DATA), "test-stage")
        out.append(docs)
    return out


def test_stages_keep_columns_and_clean_documents(steps):
    first = steps[0].columns
    assert all(s.columns == first for s in steps[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").distinct().collect()} for s in steps]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and len(ids[-1]) > 0.8 * len(ids[0])


def test_exact_and_near_copies_go(steps):
    texts = {r.doc_id: " ".join((r.text or "").split()) for r in steps[1].collect()}
    kept = {r.doc_id for r in steps[2].collect()}
    by: dict[str, list] = {}
    for i, t in texts.items():
        by.setdefault(t, []).append(i)
    assert kept == {min(v) for v in by.values()}
    near = {r.doc_id for r in steps[3].collect()}
    words = {r.doc_id: r.text.lower().split() for r in steps[2].collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} for i, w in words.items()}
    up = {i: i for i in sets}

    def find(x):
        return x if up[x] == x else find(up[x])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert near == {i for i in sets if find(i) == i}


def test_near_copies_with_repeated_and_null_ids(spark):
    """Only the near copy goes, not a clean row of the same id; null ids and equal ids within a group leave one row."""
    base = [f"w{k}" for k in range(100)]
    near = lambda k: " ".join([*base[:50], f"new{k}", *base[51:]])
    other = [" ".join(f"{t}{k}" for k in range(60)) for t in "xyz"]
    null = [other[2] + " end", other[2]]
    rows = [(1, near(0)), (2, near(1)), (2, other[0]), (3, other[1]), (1, near(2)), (None, near(3)), (None, null[0]), (None, null[1])]
    got = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3] and {r.text for r in got if r.doc_id == 2} == {other[0]}
    assert {r.text for r in got if r.doc_id == 1} <= {near(0), near(2)} and {r.text for r in got if r.doc_id is None} <= set(null)


def test_no_passage_of_fifty_words_is_left_twice(steps):
    before, after = ({r.doc_id: r.text.lower().split() for r in steps[k].collect()} for k in (3, 4))
    runs = {}
    for i, w in sorted(after.items()):
        for p in range(len(w) - 49):
            assert runs.setdefault(tuple(w[p : p + 50]), i) == i
    assert sum(map(len, after.values())) > 0.8 * sum(map(len, before.values()))


def test_nulls_empty_tables_repeats_and_odd_names(spark):
    """All stages over odd rows: each keeps the columns it was given, whatever their names."""
    text = " ".join(f"the rain in the city number {k}" for k in range(30))
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, " \t"), (None, "a lone line of words"), (5, "½ ²"), (5, "the other words of this id"), (6, text + " x")]
    odd = spark.createDataFrame([(i, t, "en", None, 0, 1, 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, row int")
    for docs, want in ((odd, {1, 5, None}), (odd.limit(0), set())):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, staged(stage(spark, docs, DATA), "odd-stage")
            assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} == want
        assert {r.doc_id for r in corpus_pipeline.packing(spark, docs, DATA).collect()} == want
    got = corpus_pipeline.near(spark, odd, DATA).collect()
    assert sorted((r.doc_id or 0) for r in got) in ([0, 1, 2, 3, 4, 5, 5], [0, 1, 1, 2, 3, 4, 5, 5])


def test_packed_documents_are_the_last_stages(steps):
    assert {r.doc_id for r in steps[5].collect()} == {r.doc_id for r in steps[4].collect()}


def test_the_rest_imports_without_this_package(tmp_path):
    """With these folders gone, the other queries are still there."""
    import shutil

    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse"))
    said = subprocess.run([sys.executable, "-c", "import json, __spark_entry__ as e; print(json.dumps(sorted(e.queries())))"], cwd=tmp_path / "r", env=os.environ | {"PYTHONPATH": str(tmp_path / "r")}, capture_output=True, text=True, timeout=120)
    names = json.loads(said.stdout)
    assert len(names) > 90 and not [n for n in names if n.startswith("op") or n == "pipeline"]


def test_near_leaves_columns_of_any_name(spark):
    names = ["_row_key", "key", "uid", "kept", "row", "row_key"]
    rows = [(1, "one two three four five six seven", 7), (2, "one two three four five six seven", 8), (3, "other words stand here for good", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a long").select("doc_id", "text", *[F.col("a").alias(n) for n in names])
    got = corpus_pipeline.near(spark, docs, DATA)
    assert got.columns == docs.columns and sorted(tuple(r) for r in got.collect()) == [(1, rows[0][1], *[7] * 6), (3, rows[2][1], *[9] * 6)]
