"""Column expressions on number arrays: windows, lengths, resampling, waveforms, posteriors. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOUBLES = "array<double>"


def _upto(n: Column | int) -> Column:
    """[0, ..., n - 1]; empty for n < 1."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n.cast("int") - 1))


def sliding_segments(x: Column, size: int = 16, step: int = 8) -> Column:
    """Segments of ``size`` every ``step``; what doesn't fill a segment is dropped."""
    n = F.floor((F.size(x) - size) / F.lit(step)) + 1
    return F.transform(_upto(n), lambda i: F.slice(x, i * step + 1, F.lit(size)))


def uniform_indices(total: Column, n: int, mode: str = "round") -> Column:
    """``n`` evenly spread indices of 0 .. total-1, rounded half to even or cut off; all 0 for a total of 1."""
    top = (total - 1).cast("double")
    at = lambda i: i.cast("double") * top / F.lit(max(n - 1, 1))
    return F.transform(_upto(n), lambda i: (F.rint(at(i)) if mode == "round" else F.floor(at(i))).cast("long"))


def needed_indices(a: Column, b: Column) -> Column:
    """Indices that either clock needs, sorted, each once."""
    return F.array_sort(F.array_union(a, b))


def fit_length(x: Column, n: int, pad: str = "last") -> Column:
    """Cut to ``n`` elements, or pad with the last one or with zero; an empty or null array stays as it is with ``last``."""
    missing = F.greatest(F.lit(n) - F.size(x), F.lit(0))
    if pad == "last":
        return F.when(F.size(x) > 0, F.concat(F.slice(x, 1, n), F.array_repeat(F.try_element_at(x, F.lit(-1)), missing))).otherwise(x)
    return F.concat(F.slice(x, 1, n), F.transform(F.array_repeat(F.lit(0), missing), lambda z: z.cast("double")))


def resample_nearest(x: Column, n: int) -> Column:
    """``n`` elements; element i is the source at floor((i + 0.5) * size / n)."""
    return F.transform(_upto(n), lambda i: F.element_at(x, (F.floor((i + F.lit(0.5)) * F.size(x) / F.lit(n)) + 1).cast("int")))


def resample_linear(x: Column, source: int, target: int) -> Column:
    """Linear resampling with half-pixel centres; max(1, round(size * target / source)) elements."""
    size = F.size(x)
    n = F.greatest(F.lit(1), F.rint(size * F.lit(target) / F.lit(source)).cast("int"))

    def at(i: Column) -> Column:
        pos = F.greatest((i + F.lit(0.5)) * size / n - F.lit(0.5), F.lit(0.0))
        low = F.least(F.floor(pos).cast("int"), size - 1)
        high = F.least(low + 1, size - 1)
        part = pos - low
        return F.element_at(x, low + 1).cast("double") * (1 - part) + F.element_at(x, high + 1).cast("double") * part

    return F.when(size > 0, F.transform(_upto(n), at))


def to_mono(channels: Column) -> Column:
    """The mean over channels; arrays with few (8 at most) samples a row and many rows are taken as samples x channels."""
    first = F.size(channels.getItem(0))
    by_channel = F.transform(_upto(first), lambda i: F.aggregate(channels, F.lit(0.0), lambda s, c: s + F.element_at(c, i + 1).cast("double")) / F.size(channels))
    by_sample = F.transform(channels, lambda s: F.aggregate(s, F.lit(0.0), lambda t, v: t + v.cast("double")) / F.size(s))
    return F.when((F.size(channels) > 8) & (first <= 8), by_sample).otherwise(by_channel)


def peak(x: Column) -> Column:
    """The largest magnitude."""
    return F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))


def peak_normalize(x: Column, level: float = 0.95) -> Column:
    """Scaled so that the peak is ``level``; a silent wave gives null."""
    p = peak(x)
    return F.transform(x, lambda v: F.try_divide(v.cast("double"), p) * F.lit(level))


def is_silent(x: Column, eps: float = 1e-6, inclusive: bool = False) -> Column:
    """Whether the peak is below ``eps``, or reaches no more than it (``inclusive``, as for the sound of videos); null and empty waves are silent."""
    return F.coalesce(peak(x) <= eps if inclusive else peak(x) < eps, F.lit(True))


def cut(x: Column, start: Column, end: Column) -> Column:
    """Samples [start, end)."""
    return F.slice(x, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def silence_if_empty(x: Column, rate: int) -> Column:
    """One second of silence in place of a null or empty wave."""
    return F.when(F.size(F.coalesce(x, F.array().cast(DOUBLES))) > 0, x.cast(DOUBLES)).otherwise(F.array_repeat(F.lit(0.0), rate))


def minmax(x: Column, eps: float = 1e-6) -> Column:
    """(x - min) / (max - min + eps)."""
    low, high = F.array_min(x).cast("double"), F.array_max(x).cast("double")
    return F.transform(x, lambda v: (v.cast("double") - low) / (high - low + F.lit(eps)))


def clamp(x: Column, low: float = -1.0, high: float = 1.0) -> Column:
    return F.transform(x, lambda v: F.greatest(F.lit(low), F.least(F.lit(high), v.cast("double"))))


def l2_normalize(x: Column) -> Column:
    """Divided by the Euclidean norm; null elements for a zero vector."""
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.transform(x, lambda v: F.try_divide(v.cast("double"), norm))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def _clamped(logvar: Column) -> Column:
    return clamp(logvar, -30.0, 20.0)


def posterior_std(logvar: Column) -> Column:
    """exp(logvar / 2) with logvar held to [-30, 20]."""
    return F.transform(_clamped(logvar), lambda v: F.exp(v * F.lit(0.5)))


def posterior_kl(mean: Column, logvar: Column) -> Column:
    """Divergence from the unit normal, element by element, as the models define it: half the squared mean, plus variance less 1 less logvar."""
    return F.zip_with(mean, _clamped(logvar), lambda m, v: F.lit(0.5) * m.cast("double") * m.cast("double") + F.exp(v) - F.lit(1.0) - v)


def posterior_nll(x: Column, mean: Column, logvar: Column) -> Column:
    """Half the sum of ln(2 pi) + logvar + (x - mean)^2 / variance."""
    diff = F.zip_with(x, mean, lambda a, m: (a.cast("double") - m.cast("double")) * (a.cast("double") - m.cast("double")))
    return F.lit(0.5) * _total(F.zip_with(diff, _clamped(logvar), lambda d, v: F.lit(1.8378770664093453) + v + d / F.exp(v)))
