"""The corpus pipeline: language ID, exact dedup, n-gram Jaccard join, substring dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipyard.llm.common import all_columns, crc_bucket, discard, staged
from clipyard.llm.exact_dedup import exact_dedup
from clipyard.llm.jaccard_join import jaccard_components
from clipyard.llm.language_id import UNDETERMINED, fit_language_model, identify_language
from clipyard.llm.packing import best_fit_pack
from clipyard.llm.substring_dedup import document_key, drop_repeated_passages, repeated_passages

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those that no learned language claims by half; the label becomes the prediction's.

    Learns from the documents with a label, but for the held-out quarter. Null and empty texts go; rows that repeat an
    id are told each for itself; without any label, or of an empty table, nothing is left. A claim by half is a weak
    test: of longer texts, some learned language nearly always has it.
    """
    model = fit_language_model(docs.filter(crc_bucket(F.col("doc_id"), 4) != 2), VOCABULARY)
    told = identify_language(docs, model, VOCABULARY, carry=F.struct(*all_columns(docs)))
    kept = told.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= 0.5))
    return kept.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (after white space, null as empty) the row of smallest id stays, a null id last; of rows that repeat id and text, one."""
    return exact_dedup(docs, keep_rows=True).filter("kept").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of smallest id stays, a null id last.

    Rows are told apart by id and text, so ids may repeat. Null, empty and blank texts link with nothing and stay; an
    empty table gives an empty one.
    """
    keyed = docs.select(document_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id"), F.col("text"), F.struct(*all_columns(docs)).alias("row"))
    gone = jaccard_components(keyed.select("key", "doc_id", "text"), row_key="key").filter("NOT kept").select(F.col("row_key").alias("key"))
    left = keyed.select("key", "row").join(gone, "key", "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; a document of which no word is left goes, null and blank texts too.

    Earlier is by id, null ids first. Rows of equal id and text are one document. ``n_chars`` becomes the new length.
    """
    found = staged(repeated_passages(docs), "pipeline-passages")
    cut = drop_repeated_passages(docs, found).withColumn("n_chars", F.length("text").cast("long"))
    return cut.filter(F.col("text").rlike("[^ \\t-\\r]")).select(*all_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences; null texts are empty documents, each row is packed for itself."""
    return best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("substring dedup", passages),
    ("best-fit packing", packing),
]

#: No SQL form: the stages' models and tokenisers aren't SQL. tests/llm compares the run with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
        if before is not None:
            discard(before)
        before = docs
    return docs
