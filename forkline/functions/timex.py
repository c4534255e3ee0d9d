"""Time helpers.  Units are always explicit; ``as_of`` replaces the wall clock."""

from pyspark.sql import Column, DataFrame, functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def unix_sql(expression: str, unit: str = "s") -> str:
    """SQL text turning a unix time in seconds (``s``) or milliseconds (``ms``) into a timestamp."""
    if unit not in ("s", "ms"):
        raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")
    return f"timestamp_{'seconds' if unit == 's' else 'millis'}(`{expression}`)"


def from_unix(c, unit: str = "s") -> Column:
    if isinstance(c, str):
        return F.expr(unix_sql(c, unit))
    return F.timestamp_seconds(c) if unit == "s" else F.timestamp_millis(c)


def format_second(c) -> Column:
    return F.date_format(c, SECOND_FORMAT)


def format_minute(c) -> Column:
    return F.date_format(c, MINUTE_FORMAT)


def start_of(c, interval: str) -> Column:
    """Start of the epoch-aligned interval, e.g. ``"5 minutes"``."""
    return F.window(c, interval).start


def reference_time(df: DataFrame, column: str, as_of=None) -> Column:
    """``as_of`` as a timestamp; by default the newest value in the data, read by an
    uncorrelated scalar subquery."""
    if as_of is None:
        return df.agg(F.max(column)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def minus(ts: Column, interval: str) -> Column:
    return ts - F.expr(f"INTERVAL {interval}")


def month_bucket(ts) -> Column:
    return F.date_format(ts, "yyyyMM")


BLOCKS_PER_BUCKET = 100_000


def block_bucket(c="block_number", width: int = BLOCKS_PER_BUCKET) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.call_function("div", c, F.lit(width).cast("bigint"))
