"""Column expressions shared by the operators.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import INSTANT_PATTERN, TXN_TIME_PATTERN

__all__ = [
    "col_of", "parse_ts", "parse_instant", "epoch_millis", "iso_millis", "partition_keys",
    "partition_path", "partition_name", "pct_rounded", "pct_text", "money_sum", "money_avg",
    "currency", "stable_uuid", "camel_name", "md5_bucket", "time_text",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, pattern: str = TXN_TIME_PATTERN) -> Column:
    """text -> TIMESTAMP_NTZ (UTC wall clock); unparseable -> null."""
    return F.try_to_timestamp(col_of(c), F.lit(pattern)).cast("timestamp_ntz")


def parse_instant(c) -> Column:
    """ISO-8601 instant (``Z`` or offset, optional millis) -> UTC TIMESTAMP_NTZ."""
    return F.try_to_timestamp(col_of(c), F.lit(INSTANT_PATTERN)).cast("timestamp_ntz")


def time_text(c, pattern: str = TXN_TIME_PATTERN) -> Column:
    """Timestamp -> producer text, e.g. ``2024-01-15T10:00:00Z``."""
    return F.date_format(col_of(c), pattern)


def epoch_millis(c) -> Column:
    """milliseconds since the epoch (truncating), the serialiser's default."""
    return F.unix_millis(col_of(c).cast("timestamp"))


def iso_millis(c) -> Column:
    """ISO text with milliseconds and ``Z``."""
    return F.date_format(col_of(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def partition_keys(ts) -> list[Column]:
    """year / zero-padded month / zero-padded day as text."""
    ts = col_of(ts)
    return [F.date_format(ts, "yyyy").alias("year"),
            F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day")]


def partition_path(year="year", month="month", day="day") -> Column:
    """``year=2024/month=01/day=15``."""
    return F.concat(F.lit("year="), col_of(year), F.lit("/month="), col_of(month),
                    F.lit("/day="), col_of(day))


def partition_name(path) -> Column:
    """file-safe partition name (``/`` -> ``_``)."""
    return F.replace(col_of(path), F.lit("/"), F.lit("_"))


def pct_rounded(part, whole, decimals: int = 1) -> Column:
    """100 * part / whole rounded half-up to ``decimals``; null when whole = 0.

    Integer arithmetic keeps the rounding exact (no binary-fraction ties); the
    final division by a power of ten is one IEEE operation.
    """
    scale = 10 ** decimals
    part, whole = col_of(part).cast("long"), col_of(whole).cast("long")
    half = F.floor(whole / F.lit(2)).cast("long")
    rounded = F.floor((part * F.lit(100 * scale) + half) / whole).cast("long")
    return F.when(whole > 0, rounded.cast("double") / F.lit(float(scale)))


def pct_text(p, decimals: int = 1) -> Column:
    """``%.1f%%`` text."""
    return F.format_string(f"%.{decimals}f%%", col_of(p))


def money_sum(c) -> Column:
    """Exact sum of 2-decimal amounts (through decimal(18,2)), 0 on empty."""
    return F.coalesce(F.sum(col_of(c).cast("decimal(18,2)")).cast("double"), F.lit(0.0))


def money_avg(c) -> Column:
    """Average from the exact sum; null on empty (A4)."""
    total = F.sum(col_of(c).cast("decimal(18,2)")).cast("double")
    return F.try_divide(total, F.count(col_of(c)).cast("double"))


def currency(c, symbol: str = "R$ ") -> Column:
    """``R$ 1,234.56``."""
    return F.concat(F.lit(symbol), F.format_number(col_of(c), 2))


def stable_uuid(c) -> Column:
    """UUID-shaped text from md5 of the value (deterministic, no ``uuid()``)."""
    h = F.md5(col_of(c).cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def md5_bucket(c, buckets: int) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of md5 (reproducible elsewhere)."""
    h32 = F.conv(F.substring(F.md5(col_of(c).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h32, F.lit(buckets))


_SPLIT = re.compile(r"[_\-\s]+")


def camel_name(name: str) -> str:
    """P2 helper (driver-side, names only): ``zip-code`` -> ``zipCode``."""
    parts = [p for p in _SPLIT.split(name) if p]
    if not parts:
        return name
    return parts[0][:1].lower() + parts[0][1:] + "".join(p[:1].upper() + p[1:] for p in parts[1:])
