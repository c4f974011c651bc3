"""Readers of manifests, inventories, onset lists and feature tables. Schemas are explicit: ids stay strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import base_name, file_ext, file_stem
from ..operators.manifest import global_rank

#: First-line cells that mark a header of a loose manifest (fixed values).
HEADER_WORDS = ("id", "path", "video", "label", "text", "caption")


def read_manifest(spark: SparkSession, path: str, caption_col: str = "caption") -> DataFrame:
    """A tab-separated manifest with a header; leading zeros of ids survive."""
    return spark.read.schema(f"id string, `{caption_col}` string").csv(path, sep="\t", header=True, escape='"')


def read_loose_manifest(spark: SparkSession, path: str, default_caption: str) -> DataFrame:
    """One or two tab-separated columns, header optional, blank lines dropped, blank captions replaced.

    Only a first line (of the file that sorts first) with a cell among HEADER_WORDS is a header; like lines in other
    places are data.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).filter("line <> ''")
    first = lines.orderBy("file", "block", "row").select("line").head(1)
    cells = F.split("line", "\t")
    rows = lines
    if first and {c.lower() for c in first[0][0].split("\t")} & set(HEADER_WORDS):
        top = lines.agg(F.min(F.struct("file", "block", "row")).alias("t"))
        rows = lines.join(F.broadcast(top), F.struct("file", "block", "row") == F.col("t"), "left_anti")
    caption = F.coalesce(F.nullif(F.trim(F.try_element_at(cells, F.lit(2))), F.lit("")), F.lit(default_caption))
    return rows.select(F.trim(cells.getItem(0)).alias("id"), caption.alias("caption"))


def read_clip_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated clips without a header: id, sec, caption, split."""
    return spark.read.schema("id string, sec int, caption string, split string").csv(path, header=False, escape='"')


def read_captions_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, caption string").csv(path, header=True, escape='"')


def read_prompt_json(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """One JSON document a file: the name is the file's (or ``name``, of its ``_metadata``), the prompt its ``audio_prompt``."""
    rows = spark.read.schema("audio_prompt string").option("recursiveFileLookup", "true").json(path, multiLine=True)
    return rows.select((file_stem(F.col("_metadata.file_name")) if name is None else name).alias("name"), "audio_prompt")


def packed_prompts(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """What ``read_prompt_json`` gives for documents kept many a file: rows of a document's path and whole text."""
    prompt = F.from_json(F.col(text), "audio_prompt string")["audio_prompt"]
    return files.select(file_stem(base_name(F.col(path))).alias("name"), prompt.alias("audio_prompt"))


def media_inventory(spark: SparkSession, path: str, exts: list[str] | None = None) -> DataFrame:
    """path, stem, ext, length of the files below a folder; their content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return name_parts(files, "path", exts)


def name_parts(files: DataFrame, path: str, exts: list[str] | None = None) -> DataFrame:
    """Stem and extension of each path, filtered by extension whatever its case, each path once."""
    name = base_name(F.col(path))
    out = files.withColumn("stem", file_stem(name)).withColumn("ext", file_ext(name))
    if exts is not None:
        out = out.filter(F.col("ext").isin([e.lower() for e in exts]))
    return out.dropDuplicates([path])


def unique_stems(files: DataFrame, path: str = "path") -> DataFrame:
    """stem, the least path of that stem, files (how many there are), pos: the listing sorted by stem, each stem once."""
    once = files.groupBy("stem").agg(F.min(path).alias(path), F.count(F.lit(1)).alias("files"))
    return global_rank(once, "stem", name="pos")


def take_until(rows: DataFrame, group: str, order: str, value: str, limit: float) -> DataFrame:
    """Rows before the first whose value reaches the limit, in order: later smaller values don't come back."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_past", F.max((F.col(value) >= limit).cast("int")).over(w)).filter("_past = 0").drop("_past")


def read_onset_times(spark: SparkSession, path: str, duration: float, name: Column | None = None) -> DataFrame:
    """file (or ``name``, of its ``_metadata``), pos, time: the first token of each line, up to the first time that reaches the duration."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    text = files.select((file_stem(F.col("_metadata.file_name")) if name is None else name).alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    times = text.filter(F.trim("line") != "").select("file", "pos", F.split("line", " ").getItem(0).cast("double").alias("time"))
    return take_until(times, "file", "pos", "time", duration)


def load_shards(features: DataFrame, ids: DataFrame) -> DataFrame:
    """The features of ``ids`` (id, pos) with their position; fails on a missing id or one that comes twice."""
    found = features.join(ids.select("id"), "id", "left_semi").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("id")))
    rows = ids.join(found.withColumn("_here", F.lit(True)), "id", "left")
    fine = F.when(F.col("_here").isNull(), F.raise_error(F.concat(F.lit("missing id "), F.col("id").cast("string")))).when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated id "), F.col("id").cast("string")))).otherwise(F.lit(True))
    return rows.filter(fine).drop("_n", "_here")


def read_features(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A feature table; only the wanted columns are read, ``id`` always."""
    df = spark.read.parquet(path)
    return df.select("id", *[c for c in columns if c != "id"]) if columns else df


def shard_order(name):
    """A numeric order key of shard names ``r<rank>_<batch>``, so that r0_2 comes before r0_10."""
    return F.struct(F.regexp_extract(name, r"r(\d+)_(\d+)", 1).try_cast("long").alias("rank"), F.regexp_extract(name, r"r(\d+)_(\d+)", 2).try_cast("long").alias("batch"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Intermediate shards with ``file`` and its numeric order ``shard``."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    file = F.regexp_extract("_metadata.file_path", r"(r\d+_\d+)", 1)
    return df.select("*", file.alias("file"), shard_order(file).alias("shard"))
