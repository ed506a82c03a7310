"""Exact ``PERCENTILE_CONT`` per group, distributed even for a group holding most rows.

First ``(group, value) -> count`` is aggregated (partial aggregation, so a hot group spreads
over all reducers). The pairs are range-partitioned on (group, value) and written with the
partition id as a column, so a group of any width spans as many slices as it needs. Running
counts inside each (partition, group) slice plus the prefix sums of the slice totals (at
most #partitions rows per group) locate the ranks, and only the pairs holding them (at most
two per percentile and group) are kept. The plan is the same at every size.

Spark's built-in ``percentile`` would merge a group's whole value->count map in one task
with no bound. Interpolation follows PostgreSQL, ``lo + (pos - floor(pos)) * (hi - lo)``,
and the group's count, min, max and sum come along, so callers need no second aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salarium.session import write_table


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str,
                      probs: dict[str, float], stats_prefix: str | None = None,
                      weight_col: str | None = None) -> DataFrame:
    """One row per group with at least one non-null value: ``group_cols`` + one double column
    per entry of ``probs`` (name -> fraction in [0, 1]).

    With ``stats_prefix`` the row also carries ``<prefix>total`` (non-null values),
    ``<prefix>min``, ``<prefix>max`` and ``<prefix>sum`` of the value.

    ``weight_col``: ``df`` is already aggregated; each row stands for that many copies of its
    value (callers pre-aggregate before a join, so the join sees distinct values only).
    """
    g = list(group_cols)
    v = value_col
    weight = F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)
    counts = df.where(F.col(v).isNotNull()).groupBy(*g, v).agg(weight.alias("_pc_n"))
    return _sliced(counts, g, v, probs, stats_prefix)


def _interpolate(lo, hi, frac):
    lo, hi = lo.cast("double"), hi.cast("double")
    return lo + frac * (hi - lo)


def _sliced(counts: DataFrame, g: list[str], v: str, probs: dict[str, float],
            stats_prefix: str | None) -> DataFrame:
    """Range slices, running counts per slice, slice offsets."""
    order = [F.col(c).asc_nulls_first() for c in g] + [F.col(v).asc()]
    sliced = write_table(counts.repartitionByRange(*order).withColumn("_pc_part", F.spark_partition_id()),
                         "percentile_slices")

    in_slice = Window.partitionBy("_pc_part", *g).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.withColumn("_pc_run", F.sum("_pc_n").over(in_slice))

    slices = sliced.groupBy("_pc_part", *g).agg(
        F.sum("_pc_n").alias("_pc_slice"),
        F.min(v).alias("_pc_smin"), F.max(v).alias("_pc_smax"),
        F.sum(F.col(v) * F.col("_pc_n")).alias("_pc_ssum"))
    earlier = Window.partitionBy(*g).orderBy("_pc_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    slices = slices.select(
        F.col("_pc_part").alias("_pc_s_part"), *[F.col(c).alias(f"_pc_s_{i}") for i, c in enumerate(g)],
        F.coalesce(F.sum("_pc_slice").over(earlier), F.lit(0)).alias("_pc_before"),
        F.sum("_pc_slice").over(whole).alias("_pc_total"),
        F.min("_pc_smin").over(whole).alias("_pc_min"),
        F.max("_pc_smax").over(whole).alias("_pc_max"),
        F.sum("_pc_ssum").over(whole).alias("_pc_sum"))

    cond = F.col("_pc_part") == F.col("_pc_s_part")
    for i, c in enumerate(g):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_pc_s_{i}"))
    located = running.join(slices, cond).select(
        *g, v, "_pc_n", (F.col("_pc_before") + F.col("_pc_run")).alias("_pc_upto"),
        "_pc_total", "_pc_min", "_pc_max", "_pc_sum")
    # ranks held by this value: [_pc_upto - n, _pc_upto)
    lo_rank = F.col("_pc_upto") - F.col("_pc_n")
    hi_rank = F.col("_pc_upto")

    def holds(rank):
        return (lo_rank <= rank) & (rank < hi_rank)

    pos = {name: (F.col("_pc_total") - 1).cast("double") * F.lit(float(p)) for name, p in probs.items()}
    hit = None
    for h in pos.values():
        term = holds(F.floor(h)) | holds(F.ceil(h))
        hit = term if hit is None else hit | term
    picked = located.where(hit)

    aggs = []
    for name, h in pos.items():
        aggs.append(F.max(F.when(holds(F.floor(h)), F.col(v))).alias(f"_pc_lo_{name}"))
        aggs.append(F.max(F.when(holds(F.ceil(h)), F.col(v))).alias(f"_pc_hi_{name}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_pc_frac_{name}"))
    stat_cols = ["_pc_total", "_pc_min", "_pc_max", "_pc_sum"]
    bounds = picked.groupBy(*g).agg(*aggs, *[F.max(c).alias(c) for c in stat_cols])

    outs = [_interpolate(F.col(f"_pc_lo_{name}"), F.col(f"_pc_hi_{name}"), F.col(f"_pc_frac_{name}")).alias(name)
            for name in probs]
    if stats_prefix is not None:
        outs += [F.col(c).alias(f"{stats_prefix}{c[len('_pc_'):]}") for c in stat_cols]
    return bounds.select(*g, *outs)
