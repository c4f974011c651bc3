"""Batched feature extraction with a caller's encoder, and the waveform jobs that need numpy."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[pd.DataFrame], pd.DataFrame]


def extract_features(df: DataFrame, make_encoder: Callable[[], Encoder], schema: str, batch: int = 64, id_col: str = "id") -> DataFrame:
    """``schema`` columns and ``error`` for each row.

    The encoder is built once a task and gets ``batch`` rows at a time. If a batch raises, its halves are tried, so a bad
    item is the only one with an error. What an Arrow batch gave goes out together.
    """
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    own = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()

        def attempt(part: pd.DataFrame, out: dict[str, list]) -> None:
            try:
                got = encode(part)
                new = {n: got[n].tolist() for n in names} | {"error": [None] * len(part)}
            except Exception as e:  # noqa: BLE001  one item's failure is its own
                if len(part) > 1:
                    attempt(part.iloc[: len(part) // 2], out)
                    attempt(part.iloc[len(part) // 2 :], out)
                    return
                new = {n: [None] for n in names} | {"error": [f"{type(e).__name__}: {e}"]}
            out[id_col] += part[id_col].tolist()
            for n, v in new.items():
                out[n] += v

        for b in batches:
            out: dict[str, list] = {n: [] for n in (id_col, *names, "error")}
            for i in range(0, len(b), batch):
                attempt(b.iloc[i : i + batch], out)
            yield pd.DataFrame({n: pd.Series(v, dtype=object).convert_dtypes() for n, v in out.items()})

    return df.mapInPandas(run, f"{id_col} {own}, {schema}, error string")


def encode_distinct(df: DataFrame, col: str, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each distinct value goes through ``encode`` (value -> value and its features) once and is joined back."""
    return df.join(encode(df.select(col).distinct()), col, "left")


@functools.lru_cache(maxsize=32)
def sinc_kernel(source: int, target: int, width: int = 64, rolloff: float = 0.9475937167399596, beta: float = 14.769656459379492) -> tuple[np.ndarray, int, int, int]:
    """Kaiser-windowed sinc filters, one a phase: (filters, half width, source step, target step)."""
    g = int(np.gcd(source, target))
    s, t = source // g, target // g
    base = min(s, t) * rolloff
    half = int(np.ceil(width * s / base))
    idx = np.arange(-half, half + s) / s
    at = (-np.arange(t)[:, None] / t + idx[None, :]) * base
    at = np.clip(at, -width, width)
    window = np.i0(beta * np.sqrt(1 - (at / width) ** 2)) / np.i0(beta)
    return np.sinc(at) * window * base / s, half, s, t


def resample_wave(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """Band-limited resampling; ceil(size * target / source) samples."""
    if source == target or not len(x):
        return x
    filters, half, s, t = sinc_kernel(source, target)
    padded = np.pad(x, (half, half + s))
    frames = np.lib.stride_tricks.sliding_window_view(padded, filters.shape[1])[::s]
    return (frames @ filters.T).ravel()[: -(-len(x) * t // s)]


def resample_band_limited(df: DataFrame, target: int, rate: str = "sample_rate", wave: str = "samples") -> DataFrame:
    """``wave`` at the target rate. A task builds the filters of each source rate once; there is no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new = [None if x is None else resample_wave(np.asarray(x, float), int(r), target) for x, r in zip(b[wave], b[rate], strict=True)]
            yield b.assign(**{wave: new, rate: target})

    kinds = ", ".join(f"`{f.name}` {'array<double>' if f.name == wave else 'int' if f.name == rate else f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, kinds)


#: Analysis settings by mode (fixed values): rate, FFT size, mel bands, hop, top frequency, logarithm.
MEL_MODES = {"16k": (16_000, 1024, 80, 256, 8_000.0, np.log10), "44k": (44_100, 2048, 128, 512, 22_050.0, np.log)}


@functools.lru_cache(maxsize=4)
def mel_filters(rate: int, n_fft: int, bands: int, top: float) -> np.ndarray:
    """Triangular filters on the Slaney mel scale, each of unit area."""
    to_mel = lambda f: np.where(f < 1000, f * 3 / 200, 15 + np.log(np.maximum(f, 1e-9) / 1000) * 27 / np.log(6.4))
    to_hz = lambda m: np.where(m < 15, m * 200 / 3, 1000 * np.exp((m - 15) * np.log(6.4) / 27))
    edges = to_hz(np.linspace(0, to_mel(np.array(top)), bands + 2))
    freq = np.fft.rfftfreq(n_fft, 1 / rate)
    up = (freq[None, :] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - freq[None, :]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def log_mel_frames(x: np.ndarray, mode: str) -> np.ndarray:
    """bands x frames: clamp to [-1, 1], reflect, Hann windows, magnitudes, mel bands, floor 1e-5, logarithm."""
    rate, n_fft, bands, hop, top, log = MEL_MODES[mode]
    pad = (n_fft - hop) // 2
    x = np.pad(np.clip(x, -1, 1), pad, mode="reflect")
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    spec = np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, n_fft)[::hop] * window, axis=1))
    return log(np.maximum(mel_filters(rate, n_fft, bands, top) @ np.sqrt(spec**2 + 1e-9).T, 1e-5))


def log_mel(df: DataFrame, mode: str, wave: str = "samples", id_col: str = "id") -> DataFrame:
    """id, frames, mel (frames x bands); null for waves too short to reflect."""
    _, n_fft, _, hop, _, _ = MEL_MODES[mode]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            mels = [None if x is None or len(x) <= (n_fft - hop) // 2 else log_mel_frames(np.asarray(x, float), mode).T for x in b[wave]]
            yield pd.DataFrame({id_col: b[id_col], "frames": [0 if m is None else len(m) for m in mels], "mel": [None if m is None else list(m) for m in mels]})

    return df.select(id_col, F.col(wave)).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, frames int, mel array<array<double>>")


def cut_wave(df: DataFrame, size: int, id_col: str = "id", wave: str = "samples", carry: list[str] | None = None) -> DataFrame:
    """id, chunk, samples and the columns ``carry``: a wave in rows of ``size`` samples, the last one shorter."""
    n = F.ceil(F.size(wave) / F.lit(size)).cast("long")
    rows = df.filter(F.size(wave) > 0).select(id_col, *(carry or []), wave, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("chunk"))
    return rows.withColumn(wave, F.slice(wave, (F.col("chunk") * size + 1).cast("int"), F.lit(size)).cast("array<double>"))


def with_halo(chunks: DataFrame, size: int, left: int, right: int, id_col: str = "id", wave: str = "samples") -> DataFrame:
    """Chunk rows with ``before`` and ``after``, the last ``left`` and first ``right`` samples of their neighbours, and ``total``, the recording's length.

    A chunk sends its ends to its neighbours, so a recording is spread over tasks by chunk. All chunks but a
    recording's last have ``size`` samples, no fewer than a halo.
    """
    if size < max(left, right):
        raise ValueError(f"chunks of {size} samples are shorter than a halo of {max(left, right)}")
    others = [c for c in chunks.columns if c not in (id_col, "chunk")]
    nothing = F.lit(None).cast("array<double>")
    own = chunks.select(id_col, "chunk", F.struct(*others).alias("own"), nothing.alias("before"), nothing.alias("after"))
    empty = F.lit(None).cast(own.schema["own"].dataType).alias("own")
    tail = F.slice(wave, F.greatest(F.size(wave) - left + 1, F.lit(1)), F.lit(left)) if left else nothing
    sent = chunks.select(id_col, (F.col("chunk") + 1).alias("chunk"), empty, tail.alias("before"), nothing.alias("after"))
    back = chunks.select(id_col, (F.col("chunk") - 1).alias("chunk"), empty, nothing.alias("before"), F.slice(wave, 1, right).alias("after"))
    any_ = lambda c: F.first(c, ignorenulls=True).alias(c)
    met = own.unionByName(sent).unionByName(back).groupBy(id_col, "chunk").agg(any_("own"), any_("before"), any_("after")).filter("own IS NOT NULL")
    totals = chunks.groupBy(id_col).agg(F.sum(F.size(wave)).alias("total"))
    flat = met.select(id_col, "chunk", "own.*", *[F.coalesce(c, F.array().cast("array<double>")).alias(c) for c in ("before", "after")])
    return flat.join(totals, id_col)


def resample_chunks(chunks: DataFrame, target: int, size: int, id_col: str = "id", rate: str = "sample_rate", wave: str = "samples", rates: tuple[int, ...] = ()) -> DataFrame:
    """Chunk rows (``cut_wave``) at the target rate: together exactly what ``resample_wave`` makes of the whole recording.

    Every chunk makes the outputs of the filter steps that begin in it, with a halo of the filter's length from its
    neighbours (overlap-save). ``rates``: the source rates that occur, looked up if not given.
    """
    found = rates or tuple(r[0] for r in chunks.select(rate).distinct().collect())  # a few rates
    reach = max([sum(sinc_kernel(int(r), target)[1:3]) for r in found if r is not None and r != target], default=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new = []
            for k, own, before, after, r, total in zip(b["chunk"], b[wave], b["before"], b["after"], b[rate], b["total"], strict=True):
                x = np.asarray(own, float)
                if r != target:
                    filters, half, s, t = sinc_kernel(int(r), target)
                    begin = int(k) * size
                    first, last = -(-begin // s), -(-(begin + len(x)) // s)  # steps that begin in the chunk
                    left, right = np.asarray(before, float), np.asarray(after, float)
                    left = np.concatenate((np.zeros(max(0, half - len(left))), left[max(0, len(left) - half) :]))
                    padded = np.concatenate((left, x, right[: half + s], np.zeros(max(0, half + s - len(right)))))
                    at = first * s - begin
                    frames = np.lib.stride_tricks.sliding_window_view(padded[at:], filters.shape[1])[::s][: last - first] if last > first else np.zeros((0, filters.shape[1]))
                    x = (frames @ filters.T).ravel()[: max(0, -(-int(total) * t // s) - first * t)]
                new.append(x)
            yield b[[c for c in b.columns if c not in ("before", "after", "total")]].assign(**{wave: new, rate: target})

    halo = with_halo(chunks, size, reach, reach, id_col, wave)
    kinds = ", ".join(f"`{f.name}` {'array<double>' if f.name == wave else 'int' if f.name == rate else f.dataType.simpleString()}" for f in halo.schema if f.name not in ("before", "after", "total"))
    return halo.mapInPandas(run, kinds)


def log_mel_chunks(chunks: DataFrame, mode: str, size: int, wave: str = "samples", id_col: str = "id") -> DataFrame:
    """id, chunk, first_frame, mel (frames x bands): of each chunk (``cut_wave``) the frames that begin in it, together those of ``log_mel``.

    The recording is reflected at its own ends only. Recordings too short to reflect give no row.
    """
    rate, n_fft, bands, hop, top, log = MEL_MODES[mode]
    pad = (n_fft - hop) // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
        for b in batches:
            out: dict[str, list] = {id_col: [], "chunk": [], "first_frame": [], "mel": []}
            for i, k, own, before, after, total in zip(b[id_col], b["chunk"], b[wave], b["before"], b["after"], b["total"], strict=True):
                begin, frames = int(k) * size, 1 + (int(total) + 2 * pad - n_fft) // hop
                first, last = -(-begin // hop), min(frames, -(-(begin + len(own)) // hop))
                if total <= pad or last <= first:
                    continue
                x = np.clip(np.concatenate([np.asarray(v, float) for v in (before, own, after)]), -1, 1)
                at = begin - len(before)  # place of x in the recording
                ends = at + len(x) == int(total)
                x = np.pad(x, (pad if at == 0 else 0, pad if ends else 0), mode="reflect")
                start = first * hop - pad - at + (pad if at == 0 else 0)
                spec = np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x[start:], n_fft)[::hop][: last - first] * window, axis=1))
                mel = log(np.maximum(mel_filters(rate, n_fft, bands, top) @ np.sqrt(spec**2 + 1e-9).T, 1e-5)).T
                for name, v in ((id_col, i), ("chunk", k), ("first_frame", first), ("mel", list(mel))):
                    out[name].append(v)
            yield pd.DataFrame(out)

    kind = chunks.schema[id_col].dataType.simpleString()
    return with_halo(chunks, size, n_fft, n_fft, id_col, wave).mapInPandas(run, f"{id_col} {kind}, chunk long, first_frame long, mel array<array<double>>")
