"""The flagship: clips of captioned recordings, with what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clips import partition_clips
from ..operators.manifest import attach_captions, usable
from .registry import Tables, query


@query("""WITH d AS (SELECT doc_id, n_chars, least(5, n_chars // 810) AS n FROM documents WHERE n_chars >= 810 AND doc_id IN (SELECT doc_id FROM labels)),
          c AS (SELECT doc_id, unnest(range(n)) AS i, CASE WHEN n > 1 THEN (n_chars - 810) // (n - 1) ELSE 0 END AS step FROM d)
          SELECT c.doc_id || '_' || i AS id, c.doc_id::VARCHAR AS name, i * step AS start_sample, i * step + 810 AS end_sample, d.lang || ' ' || d.source AS caption
          FROM c JOIN documents d ON d.doc_id = c.doc_id""")
def flagship_clips(t: Tables) -> DataFrame:
    """Recordings whose media exists, cut into clips, each with its caption."""
    have = usable(t.documents, t.labels, "doc_id")
    captions = t.documents.select(F.col("doc_id").cast("string").alias("name"), F.concat_ws(" ", "lang", "source").alias("caption"), F.col("doc_id").alias("pos"))
    return attach_captions(partition_clips(have, "doc_id", "n_chars", 100), captions, "name", "pos").select("id", "name", "start_sample", "end_sample", "caption")
