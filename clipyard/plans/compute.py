"""Queries on set operations, clips, arrays, waveforms, statistics, runs, onsets, features and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import clips as C
from ..operators import features as E
from ..operators import onsets as O
from ..operators import runs as U
from ..operators import sets as S
from ..operators import stats as Z
from ..operators.manifest import split_overlap
from ..sources.scratch import scratch_path
from ..streaming import streams as T
from .registry import Tables, query, r4, seconds

VALUES = "list_transform(embedding, lambda x: x::DOUBLE)"


def items(df: DataFrame, key: str, col: Column, kind: str = "value") -> DataFrame:
    """key, i, value: one row an array element, rounded where it's a double."""
    out = df.select(key, F.posexplode(col).alias("i", kind))
    return out.withColumn(kind, r4(F.col(kind))) if dict(out.dtypes)[kind] == "double" else out


def sql_items(inner: str, key: str = "vec_id", kind: str = "round(unnest(a), 4) + 0.0::DOUBLE") -> str:
    return f"SELECT {key}, (unnest(range(len(a))))::INTEGER AS i, {kind} AS value FROM ({inner})"


def reshaped(t: Tables) -> DataFrame:
    """vec_id, latent: vectors as 8 steps of 8 channels."""
    return t.embeddings.select("vec_id", "label", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, F.lit(8))).alias("latent"))


@query("SELECT doc_id, lang, ord AS dataset_ord, c AS copy FROM (SELECT doc_id, lang, CASE lang WHEN 'en' THEN 0 ELSE 1 END::INTEGER AS ord, unnest(CASE lang WHEN 'en' THEN [1,2,3,4,5] ELSE [1] END)::INTEGER AS c FROM documents)")
def u1_mix(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "lang")
    return S.mix([d.filter("lang = 'en'")], [d.filter("lang <> 'en'")], 5).select("doc_id", "lang", "dataset_ord", "copy")


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS sample_idx, row_number() OVER (ORDER BY source, doc_id) - 1 AS global_idx FROM documents")
def u2_global_index(t: Tables) -> DataFrame:
    return S.global_index(t.documents.select("doc_id", "source"), "doc_id", "source").select("doc_id", "source", "sample_idx", "global_idx")


@query("""WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS p, count(*) OVER () AS n FROM documents),
          w AS (SELECT doc_id // 2 AS i FROM labels UNION SELECT -1 - doc_id // 2 FROM labels)
          SELECT w.i, g.doc_id FROM w JOIN g ON g.p = CASE WHEN w.i < 0 THEN g.n + w.i ELSE w.i END""")
def u2_lookup_index(t: Tables) -> DataFrame:
    i = F.floor(F.col("doc_id") / 2)
    wanted = t.labels.select(F.explode(F.array(i, -1 - i)).alias("i")).distinct()
    return S.lookup_index(S.global_index(t.documents.select("doc_id", "source"), "doc_id", "source"), wanted).select("i", "doc_id")


@query("SELECT md5(text) AS id, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def u3_combine_shards(t: Tables) -> DataFrame:
    d = t.documents.select(F.md5(F.col("text").cast("binary")).alias("id"), "doc_id")
    return S.combine_shards(d, "id", ["doc_id"])[0]


@query("SELECT count(*) - count(DISTINCT text) AS duplicates FROM documents")
def u3_duplicates(t: Tables) -> DataFrame:
    return S.combine_shards(t.documents.select(F.md5(F.col("text").cast("binary")).alias("id"), "doc_id"), "id", ["doc_id"])[1]


@query("SELECT CASE WHEN k = 0 THEN n_name ELSE n_name || '_copy_' || k END AS id, n_regionkey FROM nation, range(3) r(k)")
def u5_replicate(t: Tables) -> DataFrame:
    return S.replicate(t.nation.select(F.col("n_name").alias("id"), "n_regionkey"), 3, "id")


@query("""WITH s AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), l AS (SELECT DISTINCT doc_id FROM labels), e AS (SELECT vec_id AS doc_id FROM embeddings)
          SELECT 'even' AS a, 'labelled' AS b, (SELECT count(*) FROM s JOIN l USING (doc_id)) AS shared
          UNION ALL SELECT 'even', 'vectors', (SELECT count(*) FROM s JOIN e USING (doc_id)) UNION ALL SELECT 'labelled', 'vectors', (SELECT count(*) FROM l JOIN e USING (doc_id))""")
def u6_split_overlap(t: Tables) -> DataFrame:
    return split_overlap({"even": t.documents.filter("doc_id % 2 = 0"), "labelled": t.labels, "vectors": t.embeddings.withColumnRenamed("vec_id", "doc_id")}, "doc_id")


@query("""WITH d AS (SELECT doc_id, n_chars, least(5, n_chars // 810) AS n FROM documents WHERE n_chars >= 810),
          c AS (SELECT doc_id, unnest(range(n)) AS i, CASE WHEN n > 1 THEN (n_chars - 810) // (n - 1) ELSE 0 END AS step FROM d)
          SELECT doc_id || '_' || i AS id, doc_id::VARCHAR AS name, i * step AS start_sample, i * step + 810 AS end_sample FROM c""")
def w1_partition_clips(t: Tables) -> DataFrame:
    return C.partition_clips(t.documents, "doc_id", "n_chars", 100)


@query("""SELECT vec_id, s::INTEGER AS s, round(list_sum(list_transform(embedding[s * 8 + 1 : s * 8 + 16], lambda x: x::DOUBLE)), 4) + 0.0::DOUBLE AS total FROM embeddings, range(7) r(s)""")
def w2_sliding_segments(t: Tables) -> DataFrame:
    seg = t.embeddings.select("vec_id", F.posexplode(A.sliding_segments(F.col("embedding"))).alias("s", "seg"))
    return seg.select("vec_id", "s", r4(F.aggregate("seg", F.lit(0.0), lambda a, x: a + x.cast("double"))).alias("total"))


@query("""SELECT o_orderkey AS id, printf('%03d', i) AS segment, i * 240 AS start_frame, round(i * 240 / 29.97::DOUBLE, 4) AS start_sec, round(240 / 29.97::DOUBLE, 4) AS seconds
          FROM (SELECT o_orderkey, unnest(range(floor(o_totalprice / 100)::BIGINT // 240)) AS i FROM orders)""")
def w3_frame_segments(t: Tables) -> DataFrame:
    out = C.frame_segments(t.orders, "o_orderkey", F.floor(F.col("o_totalprice") / 100), F.lit(29.97))
    return out.select("id", "segment", "start_frame", r4("start_sec").alias("start_sec"), r4("seconds").alias("seconds"))


@query("SELECT doc_id, i::INTEGER AS i, round_even(i * (n_chars - 1)::DOUBLE / 15, 0)::BIGINT AS value FROM documents, range(16) r(i)")
def w4_uniform_rounded(t: Tables) -> DataFrame:
    return items(t.documents, "doc_id", A.uniform_indices(F.col("n_chars"), 16, "round"))


@query("SELECT doc_id, i::INTEGER AS i, floor(i * (n_chars - 1)::DOUBLE / 15)::BIGINT AS value FROM documents, range(16) r(i)")
def w5_uniform_truncated(t: Tables) -> DataFrame:
    return items(t.documents, "doc_id", A.uniform_indices(F.col("n_chars"), 16, "floor"))


@query("""SELECT doc_id, count(*) AS n, sum(v)::BIGINT AS total FROM (SELECT DISTINCT doc_id, v FROM (
            SELECT doc_id, round_even(i * (n_chars - 1)::DOUBLE / 7, 0)::BIGINT AS v FROM documents, range(8) r(i)
            UNION ALL SELECT doc_id, round_even(i * (n_chars - 1)::DOUBLE / 24, 0)::BIGINT FROM documents, range(25) r(i))) GROUP BY doc_id""")
def w6_needed_indices(t: Tables) -> DataFrame:
    idx = A.needed_indices(A.uniform_indices(F.col("n_chars"), 8), A.uniform_indices(F.col("n_chars"), 25))
    return t.documents.select("doc_id", idx.alias("x")).select("doc_id", F.size("x").cast("long").alias("n"), F.aggregate("x", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"))


_TURNS = "SELECT conv_id, list(turn * 10 ORDER BY turn) AS x FROM conversations GROUP BY conv_id"


@query(f"SELECT conv_id, i::INTEGER AS i, x[least(i + 1, len(x))] AS value FROM ({_TURNS}), range(6) r(i)")
def w7_pad_last(t: Tables) -> DataFrame:
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.col("turn") * 10)).alias("x"))  # a conversation's turns
    return items(turns, "conv_id", A.fit_length(F.col("x"), 6, "last"))


@query("SELECT vec_id, i::INTEGER AS i, round(coalesce(embedding[i + 1]::DOUBLE, 0.0), 4) + 0.0::DOUBLE AS value FROM embeddings, range(80) r(i)")
def w8_pad_zero(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.fit_length(F.col("embedding").cast(A.DOUBLES), 80, "zero"))


@query("SELECT vec_id, i::INTEGER AS i, round(embedding[floor((i + 0.5) * 64 / 80)::INTEGER + 1]::DOUBLE, 4) + 0.0::DOUBLE AS value FROM embeddings, range(80) r(i)")
def w9_resample_nearest(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.resample_nearest(F.col("embedding").cast(A.DOUBLES), 80))


@query("""SELECT vec_id, i::INTEGER AS i, round(embedding[lo + 1]::DOUBLE * (1 - (p - lo)) + embedding[least(lo + 2, 64)]::DOUBLE * (p - lo), 4) + 0.0::DOUBLE AS value
          FROM (SELECT *, least(floor(p)::INTEGER, 63) AS lo FROM (SELECT vec_id, embedding, i, greatest((i + 0.5::DOUBLE) * 64 / 40 - 0.5, 0.0) AS p FROM embeddings, range(40) r(i)))""")
def w10_resample_linear(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.resample_linear(F.col("embedding"), 16_000, 10_000))


@query("""SELECT user_id, event_id, value, coalesce(value < min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS best FROM events""")
def w12_running_best(t: Tables) -> DataFrame:
    return U.running_best(t.events.select("user_id", "event_id", "value"), "user_id", "event_id", "value")


@query("SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id), 8) AS running_mean FROM events")
def w13_running_mean(t: Tables) -> DataFrame:
    out = U.running_mean(t.events.select("user_id", "event_id", "value"), "user_id", "event_id", "value")
    return out.select("user_id", "event_id", F.round("running_mean", 8).alias("running_mean"))


_STREAK = """WITH b AS (SELECT user_id, event_id, value, value > 100 AS bad, sum((value <= 100)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM events),
          s AS (SELECT *, sum(bad::INT) OVER (PARTITION BY user_id, island ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS streak FROM b)"""


@query(f"{_STREAK} SELECT user_id, event_id, streak::BIGINT AS streak FROM s WHERE bad AND streak = 3")
def w14_nan_streaks(t: Tables) -> DataFrame:
    return U.nan_streaks(t.events.select("user_id", "event_id", "value"), "user_id", "event_id", F.col("value") > 100, 3).select("user_id", "event_id", "streak")


_EMA = """WITH RECURSIVE x AS (SELECT user_id, t - lag(t) OVER w AS x, row_number() OVER w - 1 AS i FROM (SELECT user_id, epoch_us(ts) / 1e6 AS t FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY t)),
          e AS (SELECT user_id, i, x AS ema FROM x WHERE i = 1 UNION ALL
                SELECT x.user_id, x.i, CASE WHEN x.i = 2 THEN x.x ELSE 0.7 * e.ema + 0.3 * x.x END FROM e JOIN x ON x.user_id = e.user_id AND x.i = e.i + 1),
          r AS (SELECT user_id, max(i) AS updates, max_by(ema, i) AS ema FROM e GROUP BY user_id)"""


@query(f"{_EMA} SELECT user_id, updates, round((SELECT avg(x.x) FROM x WHERE x.user_id = r.user_id AND x.i > 0), 3) AS mean_interval, round(ema, 3) AS ema, round((1000 - updates) * ema / 10, 2) AS remaining FROM r")
def w15_interval_ema(t: Tables) -> DataFrame:
    out = U.interval_ema(t.events, "user_id", seconds(F.col("ts")), 0.7, 1000, 10)
    return out.select("user_id", "updates", F.round("mean_interval", 3).alias("mean_interval"), F.round("ema", 3).alias("ema"), F.round("remaining", 2).alias("remaining"))


#: Chunks of so many rows in the queries that make all events one run, so that it is cut at any scale of the tables.
_CHUNK = 500


def _one_run(t: Tables) -> DataFrame:
    return t.events.select(F.lit("all").alias("run"), "event_id", "user_id", "value", "event_type", seconds(F.col("ts")).alias("s"))


@query("SELECT event_id, coalesce(value < min(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS best FROM events")
def w12_one_run(t: Tables) -> DataFrame:
    """All events as one run, which spreads over tasks in chunks."""
    return U.running_best(_one_run(t), "run", "event_id", "value", _CHUNK).select("event_id", "best")


@query("SELECT event_id, round(avg(value) OVER (ORDER BY event_id), 6) AS running_mean FROM events")
def w13_one_run(t: Tables) -> DataFrame:
    return U.running_mean(_one_run(t), "run", "event_id", "value", _CHUNK).select("event_id", F.round("running_mean", 6).alias("running_mean"))


@query("""WITH b AS (SELECT event_id, value > 20 AS bad, sum((value <= 20)::INT) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
          SELECT event_id, streak::BIGINT AS streak FROM (SELECT *, sum(bad::INT) OVER (PARTITION BY island ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS streak FROM b) WHERE bad AND streak = 4""")
def w14_one_run(t: Tables) -> DataFrame:
    return U.nan_streaks(_one_run(t), "run", "event_id", F.col("value") > 20, 4, _CHUNK).select("event_id", "streak")


@query("""WITH x AS (SELECT event_type, t - lag(t) OVER w AS x, row_number() OVER w - 1 AS i FROM (SELECT event_type, epoch_us(ts) / 1e6 AS t FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY t))
          SELECT event_type, (i - 1) // 50 AS log, count(*) AS updates, round(avg(x) / 10, 4) AS mean FROM x WHERE i > 0 GROUP BY ALL""")
def w15_interval_means(t: Tables) -> DataFrame:
    """The mean time of each fifty intervals, which starts anew with each log line."""
    out = U.interval_means(t.events, "event_type", seconds(F.col("ts")), 50, 10, _CHUNK)
    return out.select("event_type", "log", "updates", r4("mean").alias("mean"))


@query("""WITH e AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, CASE event_type WHEN 'click' THEN 'start' ELSE 'end' END AS kind FROM events),
          l AS (SELECT *, lag(kind) OVER w AS k, lag(t) OVER w AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, kind))
          SELECT user_id, round(s, 3) AS start, round(t - s, 3) AS time FROM l WHERE kind = 'end' AND k = 'start'""")
def w15_timed_sections(t: Tables) -> DataFrame:
    kinds = t.events.withColumn("kind", F.when(F.col("event_type") == "click", "start").otherwise("end"))
    out = U.timed_sections(kinds, "user_id", seconds(F.col("ts")), "kind")
    return out.select("user_id", F.round("start", 3).alias("start"), F.round("time", 3).alias("time"))


@query("""WITH f AS (SELECT event_id AS idx FROM events WHERE event_type = 'click'), q AS (SELECT event_id AS idx FROM events WHERE event_type <> 'click'),
          b AS (SELECT q.idx, f.idx AS p FROM q ASOF LEFT JOIN f ON q.idx >= f.idx), n AS (SELECT q.idx, f.idx AS n FROM q ASOF LEFT JOIN f ON q.idx <= f.idx)
          SELECT idx, CASE WHEN p IS NULL THEN n WHEN n IS NULL THEN p WHEN idx - p <= n - idx THEN p ELSE n END AS frame_idx FROM b JOIN n USING (idx)""")
def j11_one_recording(t: Tables) -> DataFrame:
    e = _one_run(t).select("run", F.col("event_id").alias("idx"), "event_type")
    return C.nearest_frame(e.filter("event_type <> 'click'"), e.filter("event_type = 'click'"), "run", size=_CHUNK).select("idx", "frame_idx")


@query("""WITH u AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS time, event_id FROM events),
          k AS (SELECT unnest(range(ceil((SELECT max(time) FROM u) / 600)::BIGINT)) * 600.0::DOUBLE AS tick_time)
          SELECT k.tick_time, u.event_id FROM k ASOF JOIN u ON k.tick_time <= u.time""")
def j10_one_recording(t: Tables) -> DataFrame:
    frames = _one_run(t).select("run", (F.col("s") - F.lit(1704067200.0)).alias("time"), "event_id")
    ticks = C.clock_ticks(frames.groupBy("run").agg(F.max("time").alias("m")), "run", 1.0, F.col("m") / 600).withColumn("tick_time", F.col("k") * F.lit(600.0))
    return C.resample_clock(frames, ticks, "run", "time", "event_id", _CHUNK).select("tick_time", "event_id")


@query("""WITH u AS (SELECT user_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS time, event_id FROM events),
          k AS (SELECT user_id, unnest(range(ceil(m / 86400)::BIGINT)) * 86400.0::DOUBLE AS tick_time FROM (SELECT user_id, max(time) AS m FROM u GROUP BY user_id))
          SELECT k.user_id, k.tick_time, round(u.time, 6) AS frame_time, u.event_id FROM k ASOF JOIN u ON k.user_id = u.user_id AND k.tick_time <= u.time""")
def j10_resample_clock(t: Tables) -> DataFrame:
    frames = t.events.select("user_id", (seconds(F.col("ts")) - F.lit(1704067200.0)).alias("time"), "event_id")
    ends = frames.groupBy("user_id").agg(F.max("time").alias("m"))
    ticks = C.clock_ticks(ends, "user_id", 1.0, F.col("m") / 86400).withColumn("tick_time", F.col("k") * F.lit(86400.0))
    out = C.resample_clock(frames, ticks, "user_id", "time", "event_id")
    return out.select("user_id", "tick_time", F.round("frame_time", 6).alias("frame_time"), "event_id")


@query("""WITH f AS (SELECT user_id, event_id AS idx FROM events WHERE event_type = 'click'), q AS (SELECT user_id, event_id AS idx FROM events WHERE event_type <> 'click'),
          b AS (SELECT q.user_id, q.idx, f.idx AS p FROM q ASOF LEFT JOIN f ON q.user_id = f.user_id AND q.idx >= f.idx),
          n AS (SELECT q.user_id, q.idx, f.idx AS n FROM q ASOF LEFT JOIN f ON q.user_id = f.user_id AND q.idx <= f.idx)
          SELECT user_id, idx, CASE WHEN p IS NULL THEN n WHEN n IS NULL THEN p WHEN idx - p <= n - idx THEN p ELSE n END AS frame_idx FROM b JOIN n USING (user_id, idx)""")
def j11_nearest_frame(t: Tables) -> DataFrame:
    e = t.events.select("user_id", F.col("event_id").alias("idx"), "event_type")
    return C.nearest_frame(e.filter("event_type <> 'click'"), e.filter("event_type = 'click'"), "user_id")


@query(sql_items("SELECT vec_id, list_transform(range(32), lambda j: (embedding[j + 1]::DOUBLE + embedding[j + 33]::DOUBLE) / 2) AS a FROM embeddings"))
def v1_to_mono(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.to_mono(F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))))


@query(sql_items(f"SELECT vec_id, list_transform({VALUES}, lambda x: x / list_max(list_transform({VALUES}, lambda y: abs(y))) * 0.95) AS a FROM embeddings"))
def v2_peak_normalize(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.peak_normalize(F.col("embedding")))


@query("SELECT vec_id, label FROM embeddings WHERE label <> 0")
def v3_reject_silent(t: Tables) -> DataFrame:
    wave = F.transform("embedding", lambda x: F.when(F.col("label") == 0, F.lit(0.0)).otherwise(x.cast("double")))
    return t.embeddings.withColumn("w", wave).filter(~A.is_silent(F.col("w"))).select("vec_id", "label")


@query("SELECT vec_id, label FROM embeddings WHERE label > 1")
def v3_reject_silent_video(t: Tables) -> DataFrame:
    """A peak equal to the threshold is silent too."""
    return t.embeddings.filter(~A.is_silent(F.array(F.col("label").cast("double")), 1.0, inclusive=True)).select("vec_id", "label")


@query(sql_items("SELECT vec_id, list_transform(embedding[vec_id % 40 + 1 : vec_id % 40 + 16], lambda x: x::DOUBLE) AS a FROM embeddings"))
def v4_cut(t: Tables) -> DataFrame:
    start = F.col("vec_id") % 40
    return items(t.embeddings, "vec_id", A.cut(F.col("embedding").cast(A.DOUBLES), start, start + 16))


@query("SELECT vec_id, 40::INTEGER AS size, round(embedding[vec_id % 64 + 40]::DOUBLE, 4) AS last FROM embeddings WHERE 64 - vec_id % 64 >= 40")
def v5_require_samples(t: Tables) -> DataFrame:
    w = t.embeddings.select("vec_id", A.cut(F.col("embedding").cast(A.DOUBLES), F.col("vec_id") % 64, F.lit(64)).alias("w"))
    return C.require_samples(w, "w", 40).select("vec_id", F.size("w").alias("size"), r4(F.element_at("w", -1)).alias("last"))


@query("SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 100 ELSE 64 END::INTEGER AS size FROM embeddings")
def v6_silence_if_empty(t: Tables) -> DataFrame:
    wave = F.when(F.col("vec_id") % 4 != 0, F.col("embedding"))
    return t.embeddings.select("vec_id", F.size(A.silence_if_empty(wave, 100)).alias("size"))


@query(sql_items(f"SELECT vec_id, list_transform({VALUES}, lambda x: (x - list_min(embedding)::DOUBLE) / (list_max(embedding)::DOUBLE - list_min(embedding)::DOUBLE + 1e-6)) AS a FROM embeddings"))
def v7_minmax(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.minmax(F.col("embedding")))


@query(sql_items("SELECT vec_id, list_transform(embedding, lambda x: greatest(-1.0::DOUBLE, least(1.0::DOUBLE, x::DOUBLE * 5))) AS a FROM embeddings"))
def v8_clamp(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.clamp(F.transform("embedding", lambda x: x.cast("double") * 5)))


@query(sql_items(f"SELECT vec_id, list_transform({VALUES}, lambda x: x / sqrt(list_sum(list_transform({VALUES}, lambda y: y * y)))) AS a FROM embeddings"))
def v11_l2_normalize(t: Tables) -> DataFrame:
    return items(t.embeddings, "vec_id", A.l2_normalize(F.col("embedding")))


@query("""SELECT vec_id, round(list_sum(list_transform(range(1, 33), lambda j: exp(embedding[j + 32]::DOUBLE / 2))), 4) AS std_sum,
            round(list_sum(list_transform(range(1, 33), lambda j: 0.5 * embedding[j]::DOUBLE * embedding[j]::DOUBLE + exp(embedding[j + 32]::DOUBLE) - 1 - embedding[j + 32]::DOUBLE)), 4) AS kl_sum,
            round(0.5 * list_sum(list_transform(range(1, 33), lambda j: ln(2 * pi()) + embedding[j + 32]::DOUBLE + embedding[j]::DOUBLE * embedding[j]::DOUBLE / exp(embedding[j + 32]::DOUBLE))), 4) AS nll FROM embeddings""")
def g1_posterior(t: Tables) -> DataFrame:
    mean, logvar = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    total = lambda x: r4(F.aggregate(x, F.lit(0.0), lambda s, v: s + v))
    zero = F.array_repeat(F.lit(0.0), 32)
    return t.embeddings.select("vec_id", total(A.posterior_std(logvar)).alias("std_sum"), total(A.posterior_kl(mean, logvar)).alias("kl_sum"), r4(A.posterior_nll(zero, mean, logvar)).alias("nll"))


_LATENT = "SELECT vec_id, i, i % 8 AS channel, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i)"


@query(f"SELECT channel::INTEGER AS channel, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std FROM ({_LATENT}) GROUP BY channel")
def a1_latent_stats(t: Tables) -> DataFrame:
    return Z.latent_stats(reshaped(t), "latent").select("channel", r4("mean").alias("mean"), r4("std").alias("std"))


@query(f"""WITH l AS ({_LATENT}), s AS (SELECT channel, avg(v) AS m, stddev_samp(v) AS s FROM l GROUP BY channel)
          SELECT vec_id, round(sum((v - m) / s), 3) AS total, true AS restored FROM l JOIN s USING (channel) GROUP BY vec_id""")
def a2_normalize(t: Tables) -> DataFrame:
    x = reshaped(t)
    stats = Z.latent_stats(x, "latent")
    done = Z.normalize(x.withColumn("raw", F.flatten("latent")), "latent", stats)
    back = Z.unnormalize(done.withColumn("norm", F.flatten("latent")), "latent", stats)
    same = F.forall(F.zip_with(F.flatten("latent"), "raw", lambda a, b: F.abs(a - b.cast("double")) < 1e-6), lambda v: v)
    return back.select("vec_id", F.round(F.aggregate("norm", F.lit(0.0), lambda s, v: s + v), 3).alias("total"), same.alias("restored"))


@query("SELECT count(*) AS rows, count(DISTINCT text) AS distinct_ids, count(*) - count(DISTINCT text) AS duplicates FROM documents")
def a3_duplicate_audit(t: Tables) -> DataFrame:
    return Z.duplicate_audit(t.documents, "text")


@query("SELECT 'broken' AS feature, count(*) FILTER (vec_id % 7 = 0) AS nan_rows, count(*) FILTER (vec_id % 11 = 0) AS inf_rows, 0::BIGINT AS null_rows FROM embeddings UNION ALL SELECT 'embedding', 0, 0, 0")
def a4_feature_health(t: Tables) -> DataFrame:
    bad = F.concat(F.col("embedding").cast(A.DOUBLES), F.array(F.when(F.col("vec_id") % 7 == 0, F.lit(float("nan"))).otherwise(0.0), F.when(F.col("vec_id") % 11 == 0, F.lit(float("-inf"))).otherwise(0.0)))
    return Z.feature_health(t.embeddings.withColumn("broken", bad), ["broken", "embedding"])


@query("SELECT (8 - (vec_id % 10 = 0)::INT)::INTEGER AS t, 8::INTEGER AS d, count(*) AS rows, vec_id % 10 <> 0 AS ok FROM embeddings GROUP BY ALL")
def a5_shape_profile(t: Tables) -> DataFrame:
    x = reshaped(t).withColumn("latent", F.when(F.col("vec_id") % 10 == 0, F.slice("latent", 1, 7)).otherwise(F.col("latent")))
    return Z.shape_profile(x, "latent", (8, 8))


@query("SELECT regexp_extract(url, '^(https?)', 1) AS ext, count(*) AS files, round(sum(strlen(html)) / 1048576.0::DOUBLE, 4) AS total_mb, count(*) FILTER (strlen(html) <= 1000) AS suspicious FROM pages GROUP BY 1")
def a6_store_size(t: Tables) -> DataFrame:
    inv = t.pages.select(F.regexp_extract("url", "^(https?)", 1).alias("ext"), F.octet_length("html").alias("length"))
    return Z.store_size(inv, 1000).select("ext", "files", r4("total_mb").alias("total_mb"), "suspicious")


@query("SELECT o_orderkey % 4 AS rank, min(o_orderkey // 10) AS first_batch, max(o_orderkey // 10) AS last_batch, count(*) AS files FROM orders GROUP BY 1")
def a7_batch_range(t: Tables) -> DataFrame:
    name = F.concat(F.lit("r"), (F.col("o_orderkey") % 4).cast("string"), F.lit("_"), F.expr("o_orderkey div 10").cast("string"), F.lit(".pth"))
    return Z.batch_range(t.orders.select(name.alias("name")), "name")


@query("SELECT event_type, round(avg(m), 4) AS mean FROM (SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY ALL) GROUP BY event_type")
def a8_integrate(t: Tables) -> DataFrame:
    return Z.integrate(t.events, "event_type", "user_id", "value").select("event_type", r4("mean").alias("mean"))


@query("SELECT least(floor(value / 400 * 25), 24)::BIGINT AS bin, round(sum(value) / count(value), 4) AS mean, count(value) AS n FROM events GROUP BY 1")
def a9_binned_mean(t: Tables) -> DataFrame:
    return Z.binned_mean(t.events, "value", F.col("value") / 400).select("bin", r4("mean").alias("mean"), "n")


@query("SELECT round(sum(m) / (SELECT count(DISTINCT user_id) FROM events), 4) AS score, (SELECT count(DISTINCT user_id) FROM events) AS files FROM (SELECT user_id, avg(value) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1)")
def a10_macro_scores(t: Tables) -> DataFrame:
    e = t.events.withColumnRenamed("user_id", "file")
    scores = e.filter("event_type = 'purchase'").groupBy("file").agg(F.avg("value").alias("score"))
    return Z.macro_scores(scores, e, ["score"]).select(r4("score").alias("score"), "files")


@query("SELECT round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS loss FROM lineitem")
def a11_weighted_loss(t: Tables) -> DataFrame:
    return Z.weighted_loss(t.lineitem, "l_extendedprice", "l_quantity").select(r4("loss").alias("loss"))


@query("""SELECT d.source, count(*) AS rows, count(*) FILTER ((d.n_chars > 1500)::INT <> l.quality) AS mismatched, round(count(*) FILTER ((d.n_chars > 1500)::INT <> l.quality) / count(*)::DOUBLE, 4) AS rate
          FROM documents d JOIN labels l USING (doc_id) GROUP BY d.source""")
def a13_mismatch_rate(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", (F.col("n_chars") > 1500).cast("int").alias("long"))
    out = Z.mismatch_rate(d, t.labels, "doc_id", F.col("long"), F.col("quality"), "source")
    return out.select("source", "rows", "mismatched", r4("rate").alias("rate"))


@query("SELECT event_type, count(*) AS n, round(sum(value) / count(*), 4) AS ratio FROM events GROUP BY event_type")
def a14_hooks(t: Tables) -> DataFrame:
    agg = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return Z.with_hooks(agg, {"ratio": r4(F.col("total") / F.col("n"))}).select("event_type", "n", "ratio")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5")
def a15_caption_counts(t: Tables) -> DataFrame:
    return Z.caption_counts(t.documents, "source", 5)


@query("SELECT i, j, count(*) AS n, round(CASE WHEN i = j THEN sum(e.embedding[i + 1]::DOUBLE) ELSE 0 END, 3) AS sx, round(sum(e.embedding[i + 1]::DOUBLE * e.embedding[j + 1]::DOUBLE), 3) AS sxx FROM embeddings e, range(64) a(i), range(64) b(j) GROUP BY i, j")
def a16_moments(t: Tables) -> DataFrame:
    return Z.moments(t.embeddings, "embedding", 64).select("i", "j", "n", F.round("sx", 3).alias("sx"), F.round("sxx", 3).alias("sxx"))


@query()
def a16_compare_embeddings(t: Tables) -> DataFrame:
    e = t.embeddings
    got = Z.compare_embeddings(e.filter("vec_id % 2 = 0"), e.filter("vec_id % 2 = 1"), "embedding", 64)
    return t.spark.createDataFrame(sorted(got.items()), "metric string, value double")


@query("""WITH m AS (SELECT vec_id % 2 AS side, avg(embedding[1]::DOUBLE) AS m, stddev_samp(embedding[1]::DOUBLE) AS s FROM embeddings GROUP BY 1)
          SELECT 'frechet' AS metric, round(pow(a.m - b.m, 2) + pow(a.s - b.s, 2), 9) AS value FROM m a JOIN m b ON a.side = 0 AND b.side = 1 UNION ALL SELECT 'mean_gap', round(abs(a.m - b.m), 9) FROM m a JOIN m b ON a.side = 0 AND b.side = 1""")
def a16_compare_first(t: Tables) -> DataFrame:
    """The scores of one component, which have a closed form: far from zero, so that raw sums would cancel."""
    e = t.embeddings.select("vec_id", F.array(F.element_at("embedding", 1).cast("double") + 1e6).alias("x"))
    got = Z.compare_embeddings(e.filter("vec_id % 2 = 0"), e.filter("vec_id % 2 = 1"), "x", 1)
    return t.spark.createDataFrame(sorted(got.items()), "metric string, value double").withColumn("value", F.round("value", 9))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('3|1|' || doc_id), doc_id) - 1 AS pos FROM documents")
def f3_epoch_order(t: Tables) -> DataFrame:
    return S.epoch_order(t.documents.select("doc_id"), "doc_id", 3, 1)


@query("""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents),
          a AS (SELECT doc_id, pos AS padded_pos FROM p UNION ALL SELECT doc_id, pos + n FROM p WHERE pos < (7 - n % 7) % 7)
          SELECT doc_id, padded_pos, (padded_pos % 7)::INTEGER AS rank FROM a""")
def f4_assign_rank(t: Tables) -> DataFrame:
    from ..operators.manifest import global_rank

    return S.assign_rank(global_rank(t.documents.select("doc_id"), "doc_id", name="pos"), "pos", 7).select("doc_id", "padded_pos", "rank")


@query("SELECT doc_id, pos // 64 AS batch_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents) WHERE pos // 64 < n // 64")
def f5_assign_batch(t: Tables) -> DataFrame:
    from ..operators.manifest import global_rank

    return S.assign_batch(global_rank(t.documents.select("doc_id"), "doc_id", name="pos"), "pos", 64, True).select("doc_id", "batch_id")


@query("SELECT count(*) // 64 AS batches, 16::BIGINT AS per_rank FROM documents")
def f5_batch_counts(t: Tables) -> DataFrame:
    return S.batch_counts(t.documents, 64, 4, True)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def f7_pending(t: Tables) -> DataFrame:
    return S.pending(t.documents.select("doc_id"), t.labels, "doc_id")


@query("SELECT doc_id AS id, length(text)::BIGINT AS chars, NULL::VARCHAR AS error FROM documents WHERE doc_id % 9 <> 0 UNION ALL SELECT doc_id, NULL, 'ValueError: bad item' FROM documents WHERE doc_id % 9 = 0")
def f1_extract_features(t: Tables) -> DataFrame:
    def make() -> E.Encoder:
        def encode(b: pd.DataFrame) -> pd.DataFrame:
            if (b["id"] % 9 == 0).any():
                raise ValueError("bad item")
            return pd.DataFrame({"chars": b["text"].str.len()})

        return encode

    return E.extract_features(t.documents.select(F.col("doc_id").alias("id"), "text"), make, "chars long", 8)


def _kernel(places: int, outputs: int, which: str) -> str:
    """The resampling filter in SQL, table f (s, t, j, i, h): sinc times a Kaiser window of 64 zero crossings, its Bessel function as a series."""
    return f"""k AS (SELECT DISTINCT s, t, j, i, least(s, t) * 0.9475937167399596::DOUBLE AS base FROM v, range({places}) a(j), range({outputs}) b(i) WHERE {which}),
          w AS (SELECT *, (j / s::DOUBLE - i / t::DOUBLE) * base AS a FROM k WHERE abs((j / s::DOUBLE - i / t::DOUBLE) * base) < 64),
          f AS (SELECT s, t, j, i, CASE WHEN a = 0 THEN 1.0 ELSE sin(pi() * a) / (pi() * a) END * base / s
                   * list_sum(list_transform(range(60), lambda m: pow(14.769656459379492::DOUBLE * sqrt(1 - a * a / 4096) / 2, 2 * m) / pow(gamma(m + 1.0::DOUBLE), 2)))
                   / list_sum(list_transform(range(60), lambda m: pow(14.769656459379492::DOUBLE / 2, 2 * m) / pow(gamma(m + 1.0::DOUBLE), 2))) AS h FROM w)"""


@query(f"""WITH v AS (SELECT vec_id, embedding, CASE WHEN label % 2 = 0 THEN 2 ELSE 441 END AS s, CASE WHEN label % 2 = 0 THEN 1 ELSE 160 END AS t FROM embeddings), {_kernel(64, 64, "i < ceil(64 * t / s::DOUBLE)")},
          y AS (SELECT vec_id, i, sum(embedding[j + 1]::DOUBLE * h) AS y FROM v JOIN f USING (s, t) GROUP BY vec_id, i)
          SELECT vec_id, 8000::INTEGER AS sample_rate, count(*)::INTEGER AS size, round(max(abs(y)), 4) AS peak FROM y GROUP BY vec_id""")
def v9_resample_band_limited(t: Tables) -> DataFrame:
    out = E.resample_band_limited(_waves(t), 8_000)
    return out.select("vec_id", "sample_rate", F.size("samples").alias("size"), r4(A.peak(F.col("samples"))).alias("peak"))


def _waves(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.when(F.col("label") % 2 == 0, 16_000).otherwise(22_050).cast("int").alias("sample_rate"), F.col("embedding").cast(A.DOUBLES).alias("samples"))


@query(f"""WITH v AS (SELECT 2 AS s, 1 AS t), {_kernel(400, 1, "true")}, h AS (SELECT j AS d, h FROM f UNION ALL SELECT -j, h FROM f WHERE j > 0),
          z AS (SELECT vec_id, i, embedding[i % 64 + 1]::DOUBLE AS x FROM embeddings, range(2000) r(i) WHERE vec_id % 2 = 0),
          y AS (SELECT a.vec_id, a.i // 2 AS i, sum(b.x * h) AS y FROM z a JOIN z b ON a.vec_id = b.vec_id AND a.i % 2 = 0 JOIN h ON h.d = b.i - a.i GROUP BY ALL)
          SELECT vec_id, i // 100 AS piece, count(*) AS n, round(sum(abs(y)), 3) AS total FROM y GROUP BY ALL""")
def v9_resample_chunks(t: Tables) -> DataFrame:
    """Recordings of 2,000 samples in rows of 300, resampled with halos."""
    wave = F.slice(F.flatten(F.array_repeat("embedding", 32)), 1, 2000).cast(A.DOUBLES)
    long = t.embeddings.filter("vec_id % 2 = 0").select("vec_id", F.lit(16_000).alias("sample_rate"), wave.alias("samples"))
    out = E.resample_chunks(E.cut_wave(long, 300, "vec_id", carry=["sample_rate"]), 8_000, 300, "vec_id")
    rows = out.select("vec_id", F.posexplode("samples").alias("j", "y"), (F.col("chunk") * 150).alias("at"))
    return rows.groupBy("vec_id", F.floor((F.col("at") + F.col("j")) / 100).alias("piece")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.abs("y")), 3).alias("total"))


@query()
def v10_log_mel(t: Tables) -> DataFrame:
    wave = F.flatten(F.array_repeat("embedding", 32)).cast(A.DOUBLES)
    out = E.log_mel(t.embeddings.select(F.col("vec_id").alias("id"), wave.alias("samples")), "16k")
    return out.select("id", "frames", r4(F.element_at("mel", 1)[40]).alias("band_40"))


def _onsets(t: Tables, kind: str) -> DataFrame:
    hours = (seconds(F.col("ts")) - F.lit(1704067200.0)) / 3600
    return t.events.filter(F.col("event_type") == kind).select(F.col("user_id").alias("file"), hours.alias("pos"), "event_id", F.col("value").alias("conf"))


_HOURS = "(epoch_us(ts) - 1704067200000000) / 3.6e9"


@query(f"""SELECT p.user_id AS file, p.event_id AS pred_id, t.event_id AS truth_id FROM events p JOIN events t ON p.user_id = t.user_id AND p.event_type = 'purchase' AND t.event_type = 'click'
          AND abs({_HOURS.replace('ts', 'p.ts')} - {_HOURS.replace('ts', 't.ts')}) < 12""")
def j9_onset_candidates(t: Tables) -> DataFrame:
    pairs = O.onset_candidates(_onsets(t, "purchase"), _onsets(t, "click"), 12.0)
    return pairs.select("file", F.col("pred_event_id").alias("pred_id"), F.col("truth_event_id").alias("truth_id"))


# Values count in whole ten-thousandths: no order of summing changes their sums, so a value at the very threshold is told alike.
_PEAKS = """SELECT user_id, event_id, value FROM (SELECT *, max(units) OVER (PARTITION BY user_id ORDER BY event_id NULLS FIRST, value NULLS FIRST ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS top, sum(units) OVER around AS total, count(units) OVER around AS n
            FROM (SELECT user_id, event_id, value, round(value * 10000) AS units FROM events) WINDOW around AS (PARTITION BY user_id ORDER BY event_id NULLS FIRST, value NULLS FIRST ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)) WHERE units = top AND n * units >= total + n * 300000"""


def _envelope(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_id", F.round(F.col("value") * 10000).alias("units"), "value")


@query(_PEAKS)
def o1_pick_peaks(t: Tables) -> DataFrame:
    return O.pick_peaks(_envelope(t), "user_id", "event_id", "units", 300_000).drop("units")


@query(f"""WITH RECURSIVE p AS (SELECT user_id, event_id, max(value) AS value FROM ({_PEAKS}) GROUP BY ALL), s AS (SELECT user_id, list(event_id ORDER BY event_id) AS open, NULL::BIGINT AS kept FROM p GROUP BY user_id
            UNION ALL SELECT user_id, list_filter(open, lambda x: x - open[1] > 50), open[1] FROM s WHERE len(open) > 0)
          SELECT p.user_id, p.event_id, p.value FROM s JOIN p ON p.user_id = s.user_id AND p.event_id = s.kept""")
def o1_pick_onsets(t: Tables) -> DataFrame:
    return O.pick_onsets(_envelope(t), "user_id", "event_id", "units", 300_000, gap=50).drop("units")


@query("SELECT vec_id, round(list_max(embedding[greatest(vec_id % 64 - 5, 0) + 1 : vec_id % 64 + 5])::DOUBLE, 4) AS conf FROM embeddings")
def o2_onset_confidence(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", r4(O.onset_confidence(F.col("embedding").cast(A.DOUBLES), F.col("vec_id") % 64, 5)).alias("conf"))


@query(f"""WITH RECURSIVE s AS (SELECT user_id, list({{'c': value, 'p': {_HOURS}, 'id': event_id}} ORDER BY value DESC, {_HOURS} DESC) AS open, NULL::BIGINT AS kept FROM events WHERE event_type = 'click' GROUP BY user_id
            UNION ALL SELECT user_id, list_filter(open, lambda x: abs(x.p - open[1].p) >= 24), open[1].id FROM s WHERE len(open) > 0)
          SELECT user_id AS file, kept AS event_id FROM s WHERE kept IS NOT NULL""")
def o3_suppress(t: Tables) -> DataFrame:
    return O.suppress(_onsets(t, "click"), 24.0).select("file", "event_id")


_MATCH = f"""RECURSIVE p AS (SELECT user_id, list({{'c': value, 'h': {_HOURS}, 'id': event_id}}) AS free FROM events WHERE event_type = 'purchase' GROUP BY user_id),
          t AS (SELECT user_id, list({_HOURS} ORDER BY {_HOURS}) AS truths FROM events WHERE event_type = 'click' GROUP BY user_id),
          s AS (SELECT coalesce(p.user_id, t.user_id) AS file, coalesce(truths, []) AS truths, coalesce(free, []) AS free, 0 AS i, NULL::STRUCT(c DOUBLE, h DOUBLE, id BIGINT) AS best FROM p FULL JOIN t ON p.user_id = t.user_id
            UNION ALL SELECT file, truths, list_filter(free, lambda x: x.id IS DISTINCT FROM b.id), i + 1, b FROM (SELECT *, list_max(list_filter(free, lambda x: abs(x.h - truths[i + 1]) < 12)) AS b FROM s WHERE i < len(truths))),
          m AS (SELECT file, 1::INTEGER AS y, coalesce(best.c, 0.0::DOUBLE) AS score, best.id IS NOT NULL AS hit FROM s WHERE i > 0
            UNION ALL SELECT file, 0, x.c, false FROM (SELECT file, unnest(free) AS x FROM s WHERE i = len(truths)))"""


@query(f"WITH {_MATCH} SELECT file, y, score, hit FROM m")
def o4_match_onsets(t: Tables) -> DataFrame:
    return O.match_onsets(_onsets(t, "purchase"), _onsets(t, "click"), 12.0)


@query("""WITH b AS (SELECT d.lang, l.quality AS y, d.n_chars - 1000 AS score FROM documents d JOIN labels l USING (doc_id)),
          g AS (SELECT lang, score, sum(y) AS pos, count(*) AS n FROM b GROUP BY ALL),
          c AS (SELECT lang, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS everything, sum(pos) OVER (PARTITION BY lang) AS total FROM g WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
          f AS (SELECT lang, count(*) FILTER (score > 0 AND y = 1) AS tp, count(*) FILTER (score > 0 AND y = 0) AS fp, count(*) FILTER (score <= 0 AND y = 1) AS fn FROM b GROUP BY lang)
          SELECT c.lang, round(sum(c.pos / c.total::DOUBLE * c.tp / c.everything), 4) AS ap, round(any_value(2.0::DOUBLE * f.tp / (2 * f.tp + f.fp + f.fn)), 4) AS f1 FROM c JOIN f USING (lang) GROUP BY c.lang""")
def o5_average_precision(t: Tables) -> DataFrame:
    pairs = t.documents.join(t.labels, "doc_id").select("lang", F.col("quality").alias("y"), (F.col("n_chars") - 1000).alias("score"))
    return O.average_precision(pairs, "lang").select("lang", r4("ap").alias("ap"), r4("f1").alias("f1"))


@query(f"""WITH {_MATCH}, g AS (SELECT file, score, sum(y) AS pos, count(*) AS n FROM m GROUP BY ALL),
          c AS (SELECT file, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS everything, sum(pos) OVER (PARTITION BY file) AS total FROM g WINDOW w AS (PARTITION BY file ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
          a AS (SELECT file, coalesce(sum(pos / nullif(total, 0)::DOUBLE * tp / everything), 0.0) AS ap FROM c GROUP BY file),
          f AS (SELECT file, count(*) FILTER (hit) AS hits, count(*) FILTER (y = 1) AS truths, count(*) FILTER (score > 0 AND y = 1) AS tp, count(*) FILTER (score > 0 AND y = 0) AS fp, count(*) FILTER (score <= 0 AND y = 1) AS fn FROM m GROUP BY file)
          SELECT file, round(coalesce(hits / nullif(truths, 0)::DOUBLE, 0.0), 4) AS acc, round(ap, 4) AS ap, round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1 FROM a JOIN f USING (file)""")
def o5_score_onsets(t: Tables) -> DataFrame:
    truth = _onsets(t, "click")
    return O.score_onsets(O.match_onsets(_onsets(t, "purchase"), truth, 12.0), truth).select("file", r4("acc").alias("acc"), r4("ap").alias("ap"), r4("f1").alias("f1"))


def _log_stream(t: Tables, late: int = 0) -> DataFrame:
    """The events as a stream of a metric log: three batches of two files, the last one of ``late`` rows that come again with other values."""
    src = scratch_path(t.spark, "events-in")
    log = t.events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("run"), F.col("event_type").alias("tag"), F.col("event_id").alias("it"), "value", seconds(F.col("ts")).alias("seconds"))
    middle = t.events.approxQuantile("event_id", [0.5], 0.01)[0]
    parts = [log.filter(F.col("it") < middle), log.filter(F.col("it") >= middle)]
    if late:
        parts.append(log.filter(F.col("it") <= late).withColumn("value", F.col("value") + 1000))
    for part in parts:
        part.repartitionByRange(2, "it").sortWithinPartitions("it").write.mode("append").parquet(src)
    return t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(src)


def _drain(t: Tables, stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there and give what it wrote."""
    out = scratch_path(t.spark, "stream-out")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    with T.state_store(t.spark):
        q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", scratch_path(t.spark, "stream-state")).trigger(availableNow=True).start()
        q.awaitTermination()
    return t.spark.read.option("basePath", out).parquet(f"{out}/b=*").drop("b")


@query("""SELECT user_id AS run, event_type AS tag, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2000-01-01') AS start, round(avg(value), 4) AS mean, count(*) AS n FROM events
          GROUP BY ALL HAVING time_bucket(INTERVAL 1 DAY, any_value(ts), TIMESTAMP '2000-01-01') + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def t1_stream_metric_means(t: Tables) -> DataFrame:
    """Append mode: each closed window once; a batch of rows that come a long time late changes none."""
    out = _drain(t, T.stream_metric_means(_log_stream(t, late=200), "1 day"), "append")
    return out.select("run", "tag", F.col("start").cast("timestamp_ntz").alias("start"), r4("mean").alias("mean"), "n")


@query(_STREAK.replace("PARTITION BY user_id", "PARTITION BY user_id, event_type").replace("SELECT user_id, event_id, value,", "SELECT user_id, event_type, event_id, value,") + " SELECT user_id AS run, event_type AS tag, event_id AS it FROM s WHERE bad AND streak = 3")
def t2_stream_nan_alert(t: Tables) -> DataFrame:
    rows = _log_stream(t).select("run", "tag", "it", (F.col("value") > 100).alias("bad"), "ts")
    return _drain(t, T.stream_nan_alert(rows, 3, idle="4000 days"), "append").select("run", "tag", "it")


@query(f"{_EMA} SELECT user_id AS run, updates, round(ema, 3) AS ema FROM r")
def t3_stream_eta(t: Tables) -> DataFrame:
    out = _drain(t, T.stream_eta(_log_stream(t).select("run", "seconds", "ts"), 0.7, 1000, 10, idle="4000 days"), "update")
    last = out.groupBy("run").agg(F.max_by(F.struct("updates", "ema"), "batch").alias("x"))
    return last.select("run", "x.updates", F.round("x.ema", 3).alias("ema")).filter("updates > 0")


@query("SELECT user_id AS run, min(event_id) AS it, arg_min(event_type, event_id) AS tag, round(arg_min(value, event_id), 4) AS value FROM events GROUP BY 1")
def t4_stream_manifest(t: Tables) -> DataFrame:
    """Each run's first row, also where late rows of it come again with other values."""
    rows = _log_stream(t, late=200).select("run", "ts", "it", "tag", "value")
    return _drain(t, T.stream_manifest(rows, "400 days", "run", order=["ts", "it"], idle="4000 days"), "append").select("run", "it", "tag", r4("value").alias("value"))


@query("SELECT event_id AS it, value < 5 AS rejected FROM events")
def t5_stream_ingest(t: Tables) -> DataFrame:
    ok, bad = scratch_path(t.spark, "ok"), scratch_path(t.spark, "bad")
    T.stream_ingest(_log_stream(t).select("it", "value"), F.when(F.col("value") < 5, "too small"), ok, bad, scratch_path(t.spark, "state")).awaitTermination()
    read = lambda p: t.spark.read.option("basePath", p).parquet(f"{p}/batch=*").select("it")
    return read(ok).withColumn("rejected", F.lit(False)).unionByName(read(bad).withColumn("rejected", F.lit(True)))


@query("""WITH e AS (SELECT event_id, event_id % 3 AS batch, value < 5 AS bad, len(props) AS props_len FROM events), b AS (SELECT DISTINCT batch FROM e),
          f AS (SELECT b.batch AS after, e.batch, count(*) AS failed FROM b JOIN e ON e.batch <= b.batch AND bad GROUP BY ALL)
          SELECT b.batch AS after, count(*) AS dataset_size, count(*) FILTER (NOT bad) AS written, count(*) FILTER (bad) AS failed, (SELECT count(*) FROM f WHERE f.after = b.batch) AS num_failed_batches,
            (SELECT string_agg(f.batch || ':' || f.failed || ':too small', ' ' ORDER BY f.batch) FROM f WHERE f.after = b.batch) AS failed_batches,
            (SELECT arg_min(props_len, event_id) FROM e WHERE NOT bad AND e.batch = (SELECT min(batch) FROM e WHERE NOT bad)) AS first_props, 7::BIGINT AS expected_props
          FROM b JOIN e ON e.batch <= b.batch GROUP BY b.batch""")
def k4_batch_reports(t: Tables) -> DataFrame:
    """The report after each of three micro-batches; the last of them is run twice."""
    src, path = scratch_path(t.spark, "events-in"), scratch_path(t.spark, "reported")
    log = t.events.select(F.col("event_id").alias("id"), "value", F.length("props").alias("props_len"))
    for k in range(3):
        log.filter(F.col("id") % 3 == k).repartitionByRange(2, "id").write.mode("append").parquet(src)
    stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(src)
    state = scratch_path(t.spark, "state")
    for _ in range(2):
        T.stream_reported_ingest(stream, F.when(F.col("value") < 5, "too small"), f"{path}/ok", f"{path}/bad", f"{path}/report", state, {"props": F.col("props_len")}, {"props": 7}).awaitTermination()
        last = t.spark._jvm.org.apache.hadoop.fs.Path(f"{state}/commits/2")
        last.getFileSystem(t.spark._jsc.hadoopConfiguration()).delete(last, False)  # as if the job had been lost before the commit
    out = t.spark.read.parquet(f"{path}/report/reports")
    failed = F.array_join(F.transform("failed_batches", lambda x: F.concat_ws(":", x["batch"], x["failed"], x["error"])), " ")
    return out.select("after", "dataset_size", "written", "failed", "num_failed_batches", failed.alias("failed_batches"), F.col("first_shapes")["props"].alias("first_props"), F.col("expected_shapes")["props"].alias("expected_props"))
