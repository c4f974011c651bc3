"""SentencePiece encoding and decoding with N-best segmentations.

Pieces never cross a place where white space begins, so a text is a row of units (a run of spaces and what follows
it) and its segmentations are the products of theirs. Forward Viterbi scores of each distinct unit give the best
segmentation and the loss of the second best. The N best of a text differ from the best in at most the N-1 units
of least loss; those units' own N best come from a backward A-star search whose heuristic, the forward score, is
exact. Scores are natural log probabilities of pieces: a unigram vocabulary's own, or Zipf's of a BPE vocabulary's ranks.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, all_columns, chunks_by_bytes
from .lattice import SPACE, Pieces, best_two, load_pieces, n_best

_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def text_units(text: str) -> list[str]:
    """The units of a text after the usual space marks: a mark before the text and one for each space."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " " and SPACE not in text:
        return [SPACE + w for w in text.split(" ")]
    return _UNIT.findall(SPACE + text.replace(" ", SPACE))


def combine(choices: list[tuple[int, list[tuple[float, list[int]]]]], n: int) -> list[tuple[float, list[tuple[int, list[int]]]]]:
    """The ``n`` least total losses over independent choices: [(loss, [(unit, ids) where it isn't the best])]."""
    best: list = [(0.0, [])]
    for unit, options in choices:
        top = options[0][0]
        grown = [(loss + top - s, [*edits, (unit, ids)] if k else edits) for loss, edits in best for k, (s, ids) in enumerate(options)]
        best = heapq.nsmallest(n, grown, key=lambda x: x[0])
    return best


def _encode(model: str, n: int):
    edits_type = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("unit", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load_pieces(model)
        memo = Memo(lambda units: best_two(v, units))
        said = piece_bytes(v).__getitem__
        lists: dict[str, list] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks_by_bytes(texts, 2_000_000):
                units = [text_units(t) for t in texts[a:b]]
                memo.fill(units)
                data, sizes, nbest, same = [], [], [], []
                for t, u in zip(texts[a:b], units, strict=True):
                    scores, losses, raws = zip(*map(memo.__getitem__, u), strict=True) if u else ((), (), ())
                    raw = b"".join(raws)
                    data.append(raw)
                    sizes.append(len(raw) // 4)
                    same.append(decoded(np.frombuffer(raw, "<i4").tolist(), said) == t.replace(SPACE, " "))
                    total, loss = sum(scores), np.array(losses)
                    near = np.argpartition(loss, n - 2)[: n - 1] if len(loss) > n - 1 > 0 else np.arange(len(loss) if n > 1 else 0)
                    choices = []
                    for i in np.sort(near[np.isfinite(loss[near])]).tolist():
                        if u[i] not in lists:
                            if len(lists) > 20_000:
                                lists.clear()
                            lists[u[i]] = n_best(v, u[i], n)
                        choices.append((i, lists[u[i]]))
                    nbest.append([{"score": total - less, "edits": [{"unit": i, "ids": ids} for i, ids in e]} for less, e in combine(choices, n)])
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(data), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids, pa.array(nbest, edits_type), pa.array(same, pa.bool_())], names=["doc_id", "ids", "nbest", "round_trip"])

    return run


def encode_n_best(docs: DataFrame, model: str, n: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, ids (the best segmentation), nbest (score and the units that differ from the best; best first), round_trip.

    ``round_trip``: the ids decode to the text. Null and empty texts have no ids and one segmentation of score 0. Among
    equal scores the longer last piece wins within a unit. Long texts are encoded whole, unit by unit; a unit's lattice is
    held at once. The space mark itself counts as a space, as the format has it. Ids may be null or repeat; extra
    columns are left out; an empty table gives an empty one.
    """
    two = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return two.mapInArrow(_encode(model, n), "doc_id long, ids array<int>, nbest array<struct<score:double,edits:array<struct<unit:int,ids:array<int>>>>>, round_trip boolean")


def piece_bytes(v: Pieces) -> list[bytes]:
    """What each id adds to the decoded bytes."""
    out = [p.replace(SPACE, " ").encode() for p in v.pieces]
    if v.byte_ids is not None:
        for b, i in enumerate(v.byte_ids):
            out[i] = bytes([b])
    return out


def decoded(ids: list[int], said) -> str:
    """The text of ids; ``said`` gives a piece's bytes. The mark before the text goes; broken UTF-8 is replaced."""
    return b"".join(map(said, ids)).decode("utf-8", "replace").removeprefix(" ")


def _decode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = piece_bytes(load_pieces(model)).__getitem__
        for batch in batches:
            col = batch.column("ids")
            flat, offsets = col.flatten().to_numpy().tolist(), col.offsets.to_numpy()
            offsets = (offsets - offsets[0]).tolist()
            out = [decoded(flat[a:b], get) for a, b in zip(offsets, offsets[1:], strict=False)]
            keep = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out, pa.string())], names=[*keep, "decoded"])

    return run


def decode(rows: DataFrame, model: str) -> DataFrame:
    """Replace the column ``ids`` by ``decoded``, the text that they stand for.

    Null ids count as none; an input column named ``decoded`` gives way to the result; repeated rows are decoded each,
    rows of any length whole; an empty table gives an empty one.
    """
    keep = [c for c in rows.columns if c not in ("ids", "decoded")]
    own = [x for c, x in zip(rows.columns, all_columns(rows), strict=True) if c in keep]
    fixed = rows.select(F.struct(F.lit(0).alias("n"), *[x.alias(f"c{i}") for i, x in enumerate(own)]).alias("row"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    out = fixed.mapInArrow(_decode(model), f"row {fixed.schema['row'].dataType.simpleString()}, decoded string")
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(keep)], "decoded")
