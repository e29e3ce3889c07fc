"""Scalar expression helpers (all built-in Spark expressions, no UDFs)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse model.
# Open-ended version end.  The source model writes 2999-12-31; here the
# sentinel is the latest round date that pandas/Arrow result conversion
# (nanosecond timestamps, up to 2262-04-11) can still represent, so results
# survive ``toPandas()``.  Tables with another sentinel pass it as ``end``.
OPEN_END = "2262-01-01 00:00:00"
CLOSE_GAP = "15 seconds"                    # old version ends this long before the new one


def open_end(value: str = OPEN_END) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def ts_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def minus_interval(ts: Column | str, interval: str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return c - F.expr(f"INTERVAL {interval}")


def plus_interval(ts: Column | str, interval: str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return c + F.expr(f"INTERVAL {interval}")


def any_changed(left: str, right: str, columns: Iterable[str]) -> Column:
    """Null-safe change test (``IS DISTINCT FROM``) OR-reduced over columns."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def concat_null_as_empty(*cols: str | Column, sep: str = " ") -> Column:
    """Concatenation that treats NULL as the empty string (keeps separators)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        col = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(col.cast("string"), F.lit("")))
    return F.concat(*parts)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since epoch of a TIMESTAMP_NTZ (session time zone UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed seconds between two timestamps (days included)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", s, e)


def time_bucket(ts: Column | str, bucket_seconds: int) -> Column:
    """Integer time bucket used to split hot keys into bounded groups."""
    return F.floor(epoch_micros(ts) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def strip_blanks(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(col, F.lit(" "), F.lit(""))


def parse_decimal_comma(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """'1234,56' -> DECIMAL; unparsable text becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(F.trim(col), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def date_from_digits(c: Column | str, fmt: str) -> Column:
    """Keep the digits of a file name and parse them with ``fmt``."""
    col = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_replace(col, r"[^0-9]", "")
    if any(x in fmt for x in ("H", "m", "s")):
        return F.try_to_timestamp(digits, F.lit(fmt)).cast("timestamp_ntz")
    return F.try_to_timestamp(digits, F.lit(fmt)).cast("date")
