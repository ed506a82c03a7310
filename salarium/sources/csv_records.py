"""Multi-line CSV read by many tasks: record boundaries by quote parity over file splits.

A quoted cell may hold line ends, so whether a line starts a record depends on the quotes of
all lines before it. The files are read as lines, in splits of any size. Inside a split a
running count says how many quotes precede a line and how many records start up to it, under
both assumptions about the split's beginning (inside or outside a quoted cell). One row for
each split, its parity and its two counts, is summed over the splits of a file: that settles
the assumption and numbers the records. Lines of one record are then joined, also across
splits, and landed once as Parquet.

A quote anywhere opens or closes a quoted cell (RFC 4180); an unclosed one runs to the end of
its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salarium.plans.joins import bounded, hinted
from salarium.session import write_table


def count_fields(record: Column) -> Column:
    """Number of cells of a record (an empty record has none): quoted runs are removed in one
    linear pass, then the commas left are counted."""
    outside = F.regexp_replace(record, '"[^"]*+(?:"|$)', "")
    return F.when(record == "", 0).otherwise(F.length(outside) - F.length(F.replace(outside, F.lit(","))) + 1)


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def tagged_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, split and place, whether it stands inside quotes if its split
    begins outside (``odd``), and the records started up to it under either assumption."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), "value", (_quotes(F.col("value")) % 2).alias("odd_quotes"))
    in_split = Window.partitionBy("src_file", "split").orderBy("place")  # a group is one split of a file
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", F.coalesce(F.sum("odd_quotes").over(before), F.lit(0)) % 2)
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("starts_outside", F.sum(1 - F.col("odd")).over(upto)).withColumn("starts_inside", F.sum("odd").over(upto))


def split_offsets(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins inside a quoted cell, and the records before it."""
    splits = lines.groupBy("src_file", "split").agg(
        (F.sum("odd_quotes") % 2).alias("parity"), F.max("starts_outside").alias("outside"), F.max("starts_inside").alias("inside"))
    earlier = Window.partitionBy("src_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("begins_inside", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2 == 1)
    started = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    return splits.withColumn("started", started).select(
        F.col("src_file").alias("of_file"), F.col("split").alias("of_split"), "begins_inside",
        F.coalesce(F.sum("started").over(earlier), F.lit(0)).alias("records_before"))


def land_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a CSV file, or of the files of a folder, written once as Parquet:
    ``src_file``, ``record_no`` (from 1 in each file, the header and blank lines included),
    ``n_fields``, ``content``. The raw files are read by this one job."""
    lines = write_table(tagged_lines(spark, path), "raw-lines")
    offsets, few = bounded(split_offsets(lines))
    placed = lines.join(
        hinted(offsets, few), (F.col("src_file") == F.col("of_file")) & (F.col("split") == F.col("of_split")))
    number = F.col("records_before") + F.when(F.col("begins_inside"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    parts = F.sort_array(F.collect_list(F.struct("split", "place", "value")))
    records = placed.groupBy("src_file", number.alias("record_no")).agg(F.array_join(parts["value"], "\n").alias("content"))
    records = records.withColumn("content", F.when(
        F.endswith("content", F.lit("\r")), F.expr("left(content, length(content) - 1)")).otherwise(F.col("content")))
    return write_table(records.select("src_file", "record_no", count_fields(F.col("content")).alias("n_fields"), "content"), "raw-records")
