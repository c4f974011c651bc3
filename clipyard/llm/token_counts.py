"""Token counts: lengths of encodings, from Arrow batches.

Texts are cut at safe boundaries (a single space between two visible characters), where no token crosses; the
distinct units that a worker hasn't met go to the library in batches of about equal bytes, and only lengths stay.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, chunks_by_bytes, space_units


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def encode_units(path: str, units: list[str], batch_bytes: int = 1_000_000) -> Iterator[list[int]]:
    """Token ids of each unit, without added tokens, in batches of about ``batch_bytes``."""
    tok = _tokenizer(path)
    for a, b in chunks_by_bytes(units, batch_bytes):
        for e in tok.encode_batch_fast(units[a:b], add_special_tokens=False):
            yield e.ids


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(lambda units: map(len, encode_units(path, units)))
        get = memo.__getitem__
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n_bytes, n_tokens = [], []
            for a, b in chunks_by_bytes(texts):
                units = [space_units(t) for t in texts[a:b]]
                memo.fill(units)
                n_tokens += [sum(map(get, u)) for u in units]
                n_bytes += [len(t.encode()) for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null and empty texts have 0 bytes and tokens; ids may be null or repeat, each row is counted for itself; other
    columns are left out, whatever their names; an empty table gives an empty one. A long text is counted whole; what
    has no safe boundary, such as one word, goes to the library in one piece. ``tokenizer``: the path of a
    ``tokenizers`` JSON file on every executor. Narrow: no shuffle, one Arrow pass over two columns.
    """
    two = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = two.mapInArrow(_counter(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
