"""Session settings, stored intermediate tables and worker state shared by the operators.

Everything an operator reads twice is written once as a Parquet table in the folder that
``spark.checkpoint.dir`` names, so a lost executor costs a re-read and never a recomputation
of an upstream stage.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salarium.session import checkpoint_dir

# functions that run inside tasks travel with the task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules["salarium.llm"])

# Arrow batches are cut by bytes, because one text may be as long as thousands of others;
# shuffle files of a finished query are removed at once, because later steps read its table.
_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def configure(spark: SparkSession) -> None:
    """Set the session options the operators rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and return it as read back."""
    spark = df.sparkSession
    configure(spark)
    path = table_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str) -> Column:
    """Column by exact name, also where the name holds dots."""
    return df[f"`{name}`"]


def text_of(df: DataFrame, name: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` stored once with a key for each row, in two views: ``(key, row)`` with all
    columns in one struct, whatever their names, and ``(key, id, text)``.

    The key is written with the row, so it is the same in every later read; repeated ids,
    null ids and equal rows have keys of their own.
    """
    configure(docs.sparkSession)
    whole = docs.select(
        F.monotonically_increasing_id().alias("key"), F.struct(*(column(docs, c).alias(c) for c in docs.columns)).alias("row"))
    whole = stored(whole, "keyed")
    return whole, whole.select("key", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"))


def rows_of(whole: DataFrame) -> DataFrame:
    """The rows of ``(key, row)`` as they were before ``keyed``."""
    return whole.select(*(F.col("row").getField(c).alias(c) for c in whole.schema["row"].dataType.names))


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def per_process(key: str, make: Callable):
    """What ``make`` builds, once for each Python worker and kept between its tasks."""
    store = sys.modules.setdefault("_salarium_worker", types.ModuleType("_salarium_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
