"""Column expressions on names, captions and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """The last path segment, without a query string or fragment."""
    return F.regexp_replace(F.regexp_replace(path, "[?#].*$", ""), "^.*/", "")


def file_stem(name: Column) -> Column:
    """The name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def file_ext(name: Column) -> Column:
    """The last extension with its dot, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def clip_name(id_: Column, second: Column) -> Column:
    """``id_000012``: id and a six-digit second."""
    return F.format_string("%s_%06d", id_.cast("string"), second.cast("long"))


def subclip_id(name: Column, i: Column) -> Column:
    return F.concat_ws("_", name, i.cast("string"))


def safe_name(prompt: Column) -> Column:
    """Spaces and slashes to underscores, dots dropped."""
    return F.translate(prompt, " /.", "__")


def truth_name(name: Column) -> Column:
    """The ground-truth file of a prediction file."""
    return F.replace(name, F.lit("_denoised"), F.lit("_times"))


def pick_caption(df: DataFrame, default: str = "") -> Column:
    """By which columns exist: ``caption``, else ``label``, else the default. An existing null stays null."""
    for name in ("caption", "label"):
        if name in df.columns:
            return F.col(name)
    return F.lit(default)


def fill_caption(caption: Column, default: str) -> Column:
    """The trimmed caption, or the default where it is null or blank."""
    return F.coalesce(F.nullif(F.trim(caption), F.lit("")), F.lit(default))


def parse_rate(rate: Column, fallback: float = 29.97) -> Column:
    """``num/den`` or a number as a double; the fallback where it is null, malformed or divides by zero."""
    num = F.split(rate, "/").getItem(0).try_cast("double")
    den = F.when(rate.contains("/"), F.try_element_at(F.split(rate, "/"), F.lit(2)).try_cast("double")).otherwise(F.lit(1.0))
    return F.coalesce(F.try_divide(num, den), F.lit(fallback))


def duration_ok(samples: Column, rate: Column, duration: float, tolerance: float = 0.015) -> Column:
    """The effective duration is less than the tolerance away from the wanted one."""
    return F.abs(samples.cast("double") / rate.cast("double") - F.lit(duration)) < F.lit(tolerance)


def length_reason(n: Column, expected: int) -> Column:
    """Why a sequence can't be used (``missing``, ``too short``, ``wrong length``); null if it can."""
    return F.when(n.isNull(), "missing").when(n < expected, "too short").when(n > expected, "wrong length")
