"""Joins against derived lookup tables with a size-checked broadcast.

Aggregates (per-company statistics, per-``cui`` mappings, per-year statistics) are small in
practice but Spark's static estimate for them is the size of their input, so the planner
would shuffle the large side on the join key. A key holding a third of all rows (one year,
one big company) then lands in one task. Here the lookup table is written once, its
row count and an estimate of its bytes checked, and only a table under both bounds is
broadcast; beyond them the join is left to AQE (sort-merge join with skew splitting of hot
partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.session import write_table

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
_ROWS_KEY = "salarium.broadcast.maxRows"
_BYTES_KEY = "salarium.broadcast.maxBytes"


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        v = df.sparkSession.conf.get(key)
    except Exception:
        v = None
    return int(v) if v else default


def max_broadcast_rows(df: DataFrame) -> int:
    return _conf_int(df, _ROWS_KEY, DEFAULT_MAX_BROADCAST_ROWS)


def _row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row: string/binary lengths plus 8 bytes per other field."""
    total = F.lit(16)
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        else:
            total = total + F.lit(8)
    return total


def bounded(small: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Materialise ``small``; return it with whether it fits the broadcast bounds.

    Row count and estimated bytes of the whole written table are checked in one aggregation.
    """
    rows_bound = max_broadcast_rows(small) if max_rows is None else max_rows
    bytes_bound = _conf_int(small, _BYTES_KEY, DEFAULT_MAX_BROADCAST_BYTES) if max_bytes is None else max_bytes
    small = write_table(small, "lookup")
    n, size = small.agg(F.count(F.lit(1)), F.sum(_row_bytes(small))).first()
    return small, n <= rows_bound and (size or 0) <= bytes_bound


def hinted(table: DataFrame, fits: bool) -> DataFrame:
    """``table`` with a broadcast hint if it fits the bounds; the join itself stays the same."""
    return F.broadcast(table) if fits else table
