"""Global 1..n numbering in a given order, without moving all rows into one partition.

``row_number()`` over a global ``ORDER BY`` is planned as a single-partition window: every
row of the table goes through one task. Instead:

1. range-partition on the order columns and sort inside each partition (parallel);
2. tag every row with its partition id and position (``spark_partition_id``,
   ``monotonically_increasing_id``) and write the table once: the tags become data, so
   they stay fixed across re-execution after an executor loss and survive any later
   shuffle of the rows;
3. count rows per partition id — reading two narrow columns, one result row per
   partition — and prefix-sum those counts;
4. broadcast the per-partition offsets (bounded by the partition count) and add them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salarium.session import write_table

TAGS = ["_seq_part", "_seq_pos"]


def _sort_exprs(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sort_and_tag(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Range-partition and sort on ``order`` and add the partition id / position tags.

    Lazy: the tags are only meaningful once the result is written (``write_table``).
    Narrow steps may follow before the write (the tags are taken after them).
    """
    exprs = _sort_exprs(order)
    return df.repartitionByRange(*exprs).sortWithinPartitions(*exprs)


def add_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("_seq_part", F.spark_partition_id()).withColumn("_seq_pos", F.monotonically_increasing_id())


def number_tagged(df: DataFrame, name: str = "id", start: int = 1, counted: DataFrame | None = None) -> DataFrame:
    """Number the rows of a written table that carries the tags of ``add_tags``.

    ``counted``: the written table itself when ``df`` was derived from it row for row (e.g.
    by a lookup join that keeps every row once), so the per-partition counts read just the
    two tag columns of the table instead of recomputing ``df``.
    """
    sizes = (df if counted is None else counted).groupBy("_seq_part").agg(
        F.count(F.lit(1)).alias("_seq_n"), F.min("_seq_pos").alias("_seq_first"))
    # One row per partition: a bounded table, so a global window over it is cheap.
    before = Window.orderBy("_seq_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_seq_part", "_seq_first",
        F.coalesce(F.sum("_seq_n").over(before), F.lit(0)).alias("_seq_offset"))
    numbered = df.join(F.broadcast(offsets), "_seq_part")
    seq = F.lit(start) + F.col("_seq_offset") + (F.col("_seq_pos") - F.col("_seq_first"))
    return numbered.withColumn(name, seq.cast("bigint")).drop(*TAGS, "_seq_first", "_seq_offset")


def with_sequence(df: DataFrame, order: list[Column | str], name: str = "id", start: int = 1) -> DataFrame:
    """Append ``name`` = start, start+1, ... following ``order`` (ties in arbitrary order)."""
    return number_tagged(write_table(add_tags(sort_and_tag(df, order)), "sequenced"), name, start)


MAX_TOP_ROWS = 100_000


def first_rows(df: DataFrame, order: list[Column | str], n: int, max_top_rows: int = MAX_TOP_ROWS) -> DataFrame:
    """The first ``n`` rows in ``order`` (ties in arbitrary order).

    Few rows are a top-k: each task keeps its own first ``n`` and one task merges them. More
    than ``max_top_rows`` would be too many for that one task: the rows are numbered over range
    partitions, and those up to ``n`` kept.
    """
    if n <= max_top_rows:
        return df.orderBy(*_sort_exprs(order)).limit(n)
    return with_sequence(df, order, name="_first_rows").where(F.col("_first_rows") <= n).drop("_first_rows")
