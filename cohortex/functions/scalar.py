"""Scalar column functions used by the feature queries (all built-in, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: keep-lists of the rare-value folding and the hour-of-day buckets ----
BROWSER_KEEP = ("Chrome", "Safari", "Firefox", "Android Webview", "Edge")
OS_KEEP = ("Android", "iOS", "Windows", "Macintosh", "Linux")
OTHERS = "Others"
HOUR_BUCKETS = {
    "morning": (5, 6, 7, 8, 9, 10),
    "daytime": (11, 12, 13, 14, 15, 16),
    "evening": (17, 18, 19, 20, 21, 22),
    "midnight": (23, 24, 0, 1, 2, 3, 4),
}
SEGMENTS = ("low", "medium", "high")
# --- end of fixed values ----------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_rare(c: Column | str, keep: Sequence[str], other: str = OTHERS) -> Column:
    """Values outside ``keep`` become ``other``; null stays null (``NOT IN`` is null)."""
    c = _c(c)
    return F.when(~c.isin(list(keep)), F.lit(other)).otherwise(c)


def bool_flag(c: Column | str) -> Column:
    """``CASE WHEN c = TRUE THEN 1 ELSE 0 END``: null and false give 0."""
    return F.when(_c(c) == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def ifnull_zero(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def label_binary(c: Column | str) -> Column:
    """``IF(IFNULL(c, 0) > 0, 1, 0)``."""
    return F.when(ifnull_zero(c) > 0, F.lit(1)).otherwise(F.lit(0))


def concat_pair(a: Column | str, b: Column | str, sep: str = " / ") -> Column:
    """Null-propagating concatenation (``CONCAT``, not ``concat_ws``)."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def epoch_to_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(_c(c))


def epoch_to_ntz(c: Column | str) -> Column:
    """Epoch seconds as a zone-free UTC wall-clock timestamp (independent of the session zone)."""
    return F.timestamp_add("SECOND", _c(c), F.expr(_EPOCH_NTZ))


def local_hour(epoch_seconds: Column | str, tz: str) -> Column:
    """Hour of day of an epoch-seconds instant in zone ``tz``, whatever the session zone is."""
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(tz), epoch_to_ntz(epoch_seconds)))


def in_hours(hour: Column, hours: Sequence[int]) -> Column:
    return F.when(hour.isin(list(hours)), F.lit(1)).otherwise(F.lit(0))


def seconds_since_epoch(ts_ntz: Column | str) -> Column:
    """Whole seconds (floored) of a ``timestamp_ntz`` read as UTC."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(ts_ntz))


def hash_u32(key: Column | str, seed: int | str) -> Column:
    """Deterministic 32-bit hash of ``key|seed``: first 8 hex digits of md5, as bigint."""
    text = F.concat(_c(key).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: Column | str, seed: int | str) -> Column:
    """Uniform value in [0, 1) from ``key`` and ``seed``; same for any partitioning."""
    return hash_u32(key, seed) / F.lit(4294967296.0)


def revenue_scaled(total: Column | str, divisor: int = 100000) -> Column:
    return _c(total) / F.lit(float(divisor))


def date_minus_days(d: Column | str, days: int) -> Column:
    return F.date_sub(_c(d), days)


def date_to_text(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyyMMdd")


def text_to_date(s: Column | str) -> Column:
    return F.to_date(_c(s), "yyyyMMdd")


def md5_digest(c: Column | str) -> Column:
    return F.md5(_c(c))


def segment_label(p: Column | str, medium: float = 0.3, high: float = 0.7) -> Column:
    """``high`` if p > high, else ``medium`` if p > medium, else ``low`` (strict)."""
    p = _c(p)
    return (
        F.when(p > F.lit(high), F.lit("high"))
        .when(p > F.lit(medium), F.lit("medium"))
        .otherwise(F.lit("low"))
    )
