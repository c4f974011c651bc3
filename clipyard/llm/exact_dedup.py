"""Exact deduplication by distributed most-significant-digit radix partitioning.

All documents start in one group. Each round cuts every group by the next bytes of its documents' normalised
texts: rows with the same (group, digit) form the next groups. A group is finished when it has one document or
when its texts have ended, so equality rests on the bytes themselves, never on a digest. Digits grow 16-fold from
64 bytes to a mebibyte, so a text of L bytes takes about log16(L / 64) rounds and only rows that still share their
whole prefix are read again.

A round is a grouped count (combined before the shuffle, so a hot group costs one row a task) and a join of the
rows with the groups that have two members or more; the groups' side has one row a key, so adaptive execution can
split a hot key's rows over many tasks. Both are written to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, all_columns, staged


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", first_digit: int = 64, last_digit: int = 1 << 20, keep_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256; with ``keep_rows`` also ``row``, the whole input row.

    Null texts count as empty. Of equal texts the smallest id stays, null ids last; rows that repeat id and text form
    one group, of which one row is kept. Extra columns are left out or kept inside ``row``, so their names can't
    clash. An empty table gives an empty one. Long texts are compared to their end, by longer digits. Rows that repeat
    an id and a text are told apart by their place in the input, which has to be the same whenever it is read.
    """
    row = F.struct(*all_columns(docs)) if keep_rows else F.struct(docs[doc_id].alias(doc_id), docs[text].alias(text))
    norm = normalised(F.col("row")[text])
    active = docs.select(row.alias("row"), F.monotonically_increasing_id().alias("rid"), F.lit(0).cast("long").alias("gid")).withColumn("sha", F.sha2(norm.cast("binary"), 256))
    slim = F.col("row") if keep_rows else F.struct(F.col("row")[doc_id].alias(doc_id), F.lit(None).cast(docs.schema[text].dataType).alias(text))
    depth, width, done = 0, first_digit, []
    while True:
        bytes_ = norm.cast("binary")
        keyed = active.withColumn("digit", F.substring(bytes_, depth + 1, width)).withColumn("ended", F.octet_length(bytes_) <= F.lit(depth + width))
        id_ = F.col("row")[doc_id].cast("long")
        groups = keyed.groupBy("gid", "digit", "ended").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(id_.isNull().alias("no_id"), id_.alias("id"), F.col("rid").alias("rid"))).alias("least")).filter("n > 1").withColumn("next", F.monotonically_increasing_id())
        g = staged(groups, f"radix-groups-{depth}").select(F.col("gid").alias("g_gid"), F.col("digit").alias("g_digit"), F.col("ended").alias("g_ended"), "n", "least", "next")
        # Always by shuffle: how much moves then grows in proportion to the input, whatever the size of the groups.
        k = keyed.join(g.hint("merge"), (F.col("gid") == F.col("g_gid")) & (F.col("digit") == F.col("g_digit")) & (F.col("ended") == F.col("g_ended")), "left")
        alone, open_ = F.col("n").isNull(), F.col("n").isNotNull() & ~F.col("ended")
        cut = staged(
            k.select(
                F.when(open_, F.col("row")).otherwise(slim).alias("row"), "rid", "sha",
                F.when(open_, F.col("next")).otherwise(F.lit(-1)).cast("long").alias("gid"),
                F.when(alone, id_).otherwise(F.col("least.id")).alias("keep_id"),
                F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
                (alone | (F.col("least.rid") == F.col("rid"))).alias("kept"),
                open_.cast("int").alias("open"),
            ),
            f"radix-rows-{depth}", "open",
        )
        done.append(cut.filter("open = 0"))
        active = cut.filter("open = 1").select("row", "rid", "gid", "sha")
        if active.isEmpty():
            break
        depth, width = depth + width, min(width * 16, last_digit)
    out = reduce(DataFrame.unionByName, done)
    return out.select(F.col("row")[doc_id].cast("long").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"), *(["row"] if keep_rows else []))
