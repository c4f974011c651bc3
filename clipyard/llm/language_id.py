"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary; a text's likelihood is the sum over
all its segmentations, by a forward algorithm. No piece crosses a word start, so a text's log-likelihood is the sum
of its words', and each distinct word is summed once a worker. Training counts pieces of the training words in
each language; the model has (languages x vocabulary) rows, whatever the corpus.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import Memo, chunks_by_bytes, gives_back
from .lattice import SPACE, load_pieces, log_marginals

_MAYBE = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    """Whether a character has the Unicode category L; numbers such as one half or a superscript haven't."""
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


@functools.lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def add_piece_counts(into: np.ndarray, model: str, words: list[str], weights: list[int]) -> None:
    """Add each word's pieces, as the vocabulary's own encoder cuts it, ``weights`` times."""
    for a in range(0, len(words), 20_000):
        ids = processor(model).encode(words[a : a + 20_000], num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.int64, int(sizes.sum()))
        into += np.bincount(flat, weights=np.repeat(np.array(weights[a : a + 20_000], float), sizes), minlength=len(into))


def _count(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = processor(model).get_piece_size()
        counts: dict[str, np.ndarray] = {}
        docs: Counter = Counter()
        words: dict[str, Counter] = defaultdict(Counter)

        def flush() -> None:
            for lang, c in words.items():
                add_piece_counts(counts.setdefault(lang, np.zeros(size)), model, list(c), list(c.values()))
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs[lang] += 1
                words[lang].update((text or "").lower().split())
            if sum(map(len, words.values())) > 150_000:
                flush()
        flush()
        for lang in docs:
            c = counts.get(lang, np.zeros(size))
            ids = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(ids) + 1)), pa.array(np.append(ids, -1)), pa.array(np.append(c[ids], docs[lang]))], names=["lang", "piece", "n"])

    return gives_back(run)


class LanguageModel:
    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray):
        self.langs, self.logp, self.prior = langs, logp, prior


def fit_language_model(train: DataFrame, model: str, text: str = "text", lang: str = "lang", smoothing: float = 0.1, max_langs: int = 500) -> LanguageModel:
    """Piece probabilities and document shares of each language in ``train``; rows with a null language are left out.

    Null and empty texts count for their language's share only; extra columns are left out; an empty table gives a
    model without languages, by which every text is undetermined. A long text is counted whole, word by word. Raises if there are more than ``max_langs`` languages, the bound of what the driver holds and broadcasts.
    """
    two = train.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).filter("lang IS NOT NULL")
    rows = two.mapInArrow(_count(model), "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    v = load_pieces(model)
    got = rows.limit((max_langs + 1) * (v.size + 1)).toPandas()
    langs = sorted(got["lang"].unique())
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    counts, docs = np.full((v.size, max(1, len(langs))), smoothing), np.zeros(len(langs))
    for i, name in enumerate(langs):
        own = got[got["lang"] == name]
        docs[i] = own.loc[own["piece"] < 0, "n"].sum()
        own = own[own["piece"] >= 0]
        counts[own["piece"].to_numpy(), i] += own["n"].to_numpy()
    return LanguageModel(langs, np.log(counts / counts.sum(axis=0)), np.log(docs / max(1.0, docs.sum())))


def _predict(model: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, v = shared.value, load_pieces(model)
        memo = Memo(lambda words: log_marginals(v, [SPACE + w for w in words], m.logp), limit=100_000)
        for batch in batches:
            texts, preds, scores = [t or "" for t in batch.column(1).to_pylist()], [], []
            for a, b in chunks_by_bytes(texts):
                words = [t.lower().split() for t in texts[a:b]]
                memo.fill(words)
                for t, w in zip(texts[a:b], words, strict=True):
                    if not m.langs or not has_letter(t):
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    x = m.prior + np.array(list(map(memo.__getitem__, w))).sum(axis=0)
                    k = int(np.argmax(x))
                    preds.append(m.langs[k])
                    scores.append(float(1 / np.exp(x - x[k]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    return gives_back(run)


def identify_language(docs: DataFrame, lm: LanguageModel, model: str, text: str = "text", carry: Column | None = None) -> DataFrame:
    """row, lang_pred, score of every row. ``row``: the column or struct to carry, else ``doc_id``.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned; otherwise the score
    is the language's posterior probability and ties go to the first name. Ids may be null or repeat; each row is
    told for itself, whole, however long. Extra columns are left out unless carried; an empty table gives an empty one.
    """
    row = F.col("doc_id") if carry is None else carry
    two = docs.select(row.alias("row"), F.col(text).cast("string").alias("text"))
    out = StructType([two.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return two.mapInArrow(_predict(model, docs.sparkSession.sparkContext.broadcast(lm)), out)
