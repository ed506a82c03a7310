"""Bad text and unreadable tables are errors, whatever the session's settings are."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salarium.functions.amounts import cast_or_fail, digits_to_int
from salarium.operators import audit


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_bad_integers_raise(spark, ansi):
    df = spark.createDataFrame([("7",), (None,)], "t string")
    assert [r[0] for r in df.select(cast_or_fail(F.col("t"), "int")).collect()] == [7, None]
    with pytest.raises(PySparkException, match="abc"):
        spark.createDataFrame([("abc",)], "t string").select(cast_or_fail(F.col("t"), "int")).collect()


def test_amounts_beyond_bigint_raise(spark, ansi):
    with pytest.raises(PySparkException, match="1234567890123456789012345"):
        spark.createDataFrame([("1234567890123456789012345",)], "t string").select(digits_to_int(F.col("t"))).collect()


def test_only_a_missing_path_means_nothing_stored(spark, tmp_dir):
    assert audit._read_if_exists(spark, tmp_dir + "/none") is None
    with open(tmp_dir + "/broken", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        audit._read_if_exists(spark, tmp_dir + "/broken")
