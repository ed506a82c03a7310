"""File sources and sinks S1-S6, S10, S12, S14.

Raw CSV files are landed once as records (``csv_records``), read by as many tasks as they
have splits; the table and the report on malformed records are made from the landed records.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salarium.functions.text import na_token_blank
from salarium.operators.cleaning import BOOKKEEPING, POSITION, normalize_columns, rename_source
from salarium.sources.csv_records import count_fields, land_records

BAD = "_bad"
# RFC 4180 quoting as the reference's CSV files use it: a quote inside a quoted field is
# doubled (Spark's default escape character would be a backslash).
CSV_QUOTING = {"quote": '"', "escape": '"'}
# Writers keep cell text exactly (Spark would trim surrounding blanks on write by default)
# and write an empty cell as nothing, not as "" (only quote-all output quotes it).
CSV_WRITE = {**CSV_QUOTING, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**CSV_QUOTING).option("header", True).option("multiLine", True).csv(path).columns


def _read_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns] + [StructField(BAD, StringType())])
    return (spark.read.schema(schema)
            .options(**CSV_QUOTING)
            .option("header", True)
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD)
            .option("enforceSchema", False)
            .csv(path))


def read_raw(spark: SparkSession, path: str, landed: DataFrame | None = None) -> DataFrame:
    """S1 (+P1, P2): every cell a string, '' for missing cells, no NA inference.

    Records with more fields than the header are dropped (the reference warns and skips
    them); shorter records are padded with ''; blank lines are skipped. ``src_file`` and
    ``src_row`` (the record's number in its file) give each row's place. ``landed``: the
    result of ``land_records`` for ``path``, where the caller has it already.
    Header texts may hold dots, parentheses or line breaks, so columns are handled by
    position until the names are normalised.
    """
    header = _header(spark, path)
    pos = [f"_c{i}" for i in range(len(header))]
    records = land_records(spark, path) if landed is None else landed
    rows = records.where((F.col("record_no") > 1) & F.col("n_fields").between(1, len(header)))
    cells = F.from_csv("content", ", ".join(f"{c} string" for c in pos), {**CSV_QUOTING, "mode": "PERMISSIVE"})
    rows = rows.select("src_file", F.col("record_no").alias("src_row"), cells.alias("cells"))
    df = rows.select("src_file", "src_row", *[F.coalesce(F.col(f"cells.{c}"), F.lit("")).alias(c) for c in pos])
    return rename_source(normalize_columns(df.toDF("src_file", "src_row", *header)))


def malformed_records(spark: SparkSession, path: str, landed: DataFrame | None = None) -> DataFrame:
    """Records whose field count differs from the header's: file, number of the record in
    its file (from 1, the header and blank lines included), field count and content."""
    records = land_records(spark, path) if landed is None else landed
    expected = len(_header(spark, path))
    return records.where((F.col("record_no") > 1) & (F.col("n_fields") != expected)).select(
        "src_file", "record_no", "n_fields", "content")


def count_malformed(spark: SparkSession, path: str, landed: DataFrame | None = None) -> int:
    """Number of malformed records (the quality report's ``bad_line_count``)."""
    return malformed_records(spark, path, landed).count()


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """S3: re-read a cleaned CSV as strings; NA tokens -> ''; over-long records skipped."""
    header = _header(spark, path)
    pos = [f"_c{i}" for i in range(len(header))]
    df = _read_strings(spark, path, header).toDF(*pos, BAD)
    df = df.where(F.col(BAD).isNull() | (count_fields(F.col(BAD)) <= F.lit(len(header))))
    return df.select(*[na_token_blank(F.col(c)).alias(c) for c in pos]).toDF(*header)


def write_clean(df: DataFrame, path: str) -> None:
    """Persist the cleaned table as CSV with a header (UTF-8)."""
    _in_file_order(df).write.mode("overwrite").options(**CSV_WRITE).option("header", True).csv(path)


def _in_file_order(df: DataFrame) -> DataFrame:
    """``df`` sorted by its place in the input, where it has one, without the bookkeeping."""
    order = [c for c in POSITION if c in df.columns]
    return (df.orderBy(*order) if order else df).drop(*BOOKKEEPING)


def write_validated(df: DataFrame, path: str, counts: list[Column] | None = None) -> dict:
    """Every field quoted, '\\n' line ends. ``counts``: aggregates over the written rows,
    taken by the write itself and returned by name, so no other scan is needed for them.

    They are observed after the sort, in the tasks that write: its sampling pass, or a task
    that is run again, counts no row twice.
    """
    rows, seen = _in_file_order(df), Observation()
    if counts:
        rows = rows.observe(seen, *counts)
    (rows.write.mode("overwrite").options(**{**CSV_WRITE, "emptyValue": '""'})
       .option("header", True).option("quoteAll", True).option("lineSep", "\n").csv(path))
    return seen.get if counts else {}


RELOAD_GUARD = "salarium.reload.allowedPrefixes"


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _previous(path: str) -> str:
    return f"{path.rstrip('/')}.previous"


def full_reload(df: DataFrame, path: str, allowed_prefixes: tuple[str, ...] | None = None,
                fmt: str = "parquet") -> None:
    """Idempotent replace — the state after a run depends only on the current input.

    The new state is written beside the target; the old one is set aside under
    ``<path>.previous`` and deleted only when the new one stands in its place, so at every
    moment one whole state is there (``read_reloaded`` finds it). Destructive overwrites are
    guarded: a target outside ``allowed_prefixes`` (default: those that the session setting
    ``salarium.reload.allowedPrefixes`` lists, separated by commas) is refused.
    """
    spark = df.sparkSession
    if allowed_prefixes is None:
        listed = spark.conf.get(RELOAD_GUARD, None)
        allowed_prefixes = tuple(p.strip() for p in listed.split(",")) if listed else None
    if allowed_prefixes is not None and not any(path.startswith(p) for p in allowed_prefixes):
        raise PermissionError(f"refusing to overwrite {path!r}: not under an allowed prefix")
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.format(fmt).save(staging)
    target, fs = _folder(spark, path)
    old, new = _folder(spark, _previous(path))[0], _folder(spark, staging)[0]
    if fs.exists(target):
        fs.delete(old, True)
        if not fs.rename(target, old):
            raise OSError(f"{path} could not be set aside")
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"{staging} could not take the place of {path}")
    fs.delete(old, True)


def read_reloaded(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The state that ``full_reload`` left: the target, or the one set aside by a reload that
    ended between its steps."""
    target, fs = _folder(spark, path)
    return spark.read.format(fmt).load(path if fs.exists(target) else _previous(path))


def publish(df: DataFrame, uri: str, partition_by: list[str] | None = None) -> None:
    """The cleaned table under a stable key of any Hadoop file system URI.

    The table is written in file order as CSV parts, each with the header, and then
    ``<uri>.parts``, a small CSV: name, bytes and lines of each part in order. Whoever finds the
    list finds a whole artifact (``read_published``). One file for the whole table would
    have to pass through one machine, so it is not made. With ``partition_by`` the table
    is dealt into folders by those columns and has no list.
    """
    if partition_by:
        out = df.drop(*BOOKKEEPING).write.mode("overwrite").options(**CSV_WRITE).option("header", True)
        out.partitionBy(*partition_by).csv(uri)
        return
    spark, uri = df.sparkSession, uri.rstrip("/")
    listing, fs = _folder(spark, f"{uri}.parts")
    fs.delete(listing, True)  # no list stands while parts are replaced
    _in_file_order(df).write.mode("overwrite").options(**CSV_WRITE).option("header", True).csv(uri)
    parts = spark.read.option("lineSep", "\n").text(uri).groupBy(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("lines"))
    # one row per file; names of parts ascend in file order
    parts.coalesce(1).sortWithinPartitions("part").write.option("header", True).csv(f"{uri}.parts")


def read_published(spark: SparkSession, uri: str) -> DataFrame:
    """The cells that ``publish`` left under ``uri``; an error where the parts there are not
    those its list names."""
    uri = uri.rstrip("/")
    listed = spark.read.schema("part string, bytes long, lines long").option("header", True).csv(f"{uri}.parts")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(uri).select(
        F.element_at(F.split("path", "/"), -1).alias("part"), F.col("length").alias("bytes")).where("bytes > 0")
    both = found.join(listed.select("part", F.col("bytes").alias("listed")), "part", "full")
    if not both.where(~F.col("bytes").eqNullSafe(F.col("listed"))).isEmpty():
        raise RuntimeError(f"the parts at {uri} are not those its list names")
    return _read_strings(spark, uri, _header(spark, uri)).drop(BAD).na.fill("")


def read_json_records(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Records landed as JSON; at least one record is required."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if df.isEmpty():
        raise ValueError(f"no record landed at {path}")
    return df


def json_records_summary(df: DataFrame) -> tuple[int, str]:
    """Number of landed records and the first one as JSON text (one row reaches the
    driver, not the data)."""
    n = df.count()
    sample = df.limit(1).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j")).first()
    return n, sample.j if sample else ""


def write_quality_report(report: DataFrame, path: str, input_file: str, output_file: str) -> None:
    """One JSON object per run, appended, with the counts plus timestamp, paths and status."""
    ts = _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0).isoformat().replace("+00:00", "Z")
    (report.select(F.lit(ts).alias("run_timestamp_utc"), F.lit(input_file).alias("input_file"),
                   F.lit(output_file).alias("output_file"), *report.columns)
           .coalesce(1).write.mode("append").json(path))
