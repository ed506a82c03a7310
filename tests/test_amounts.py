"""Golden amount strings (placeholder -> split -> clean -> digits) and single-cell rules."""

import pytest
from pyspark.sql import functions as F

from salarium.functions.amounts import clean_amount_text, digits_to_int
from salarium.operators import cleaning

# (suma in, variabila in, suma out, variabila out, suma_num, variabila_num)
GOLDEN = [
    ("31 530", "", "31530", "", 31530, 0),
    ("23316/46632", "", "46632", "", 46632, 0),
    ("71000+71000", "", "142000", "", 142000, 0),
    ("5000 - 2000", "999", "5000", "2000", 5000, 2000),
    ("4,455", "null", "4,455", "", 4455, 0),
    ("3.50 lei", "-", "3.50", "", 350, 0),
    ("-500", "", "-500", "", 500, 0),
    ("500+", "", "500+", "", 500, 0),
    ("500/", "", "500/", "", 500, 0),
    ("100/200+300", "", "100500", "", 100500, 0),
    ("1000 - 200+100", "", "1000", "300", 1000, 300),
    ("nu a fost stabilită", "N/A", "", "", 0, 0),
    ("-", "", "", "", 0, 0),
]


def _pipeline(spark, rows):
    df = spark.createDataFrame(
        [(i, s, v) for i, (s, v, *_ ) in enumerate(rows)], "src_row long, suma string, indemnizatie_variabila string")
    df = cleaning.clean_text(df)
    df = cleaning.blank_placeholders(df)
    df = cleaning.split_base_variable(df)
    df = cleaning.clean_amounts(df)
    df = cleaning.amounts_numeric(df)
    return {r.src_row: r for r in df.collect()}


def test_golden_amounts(spark):
    got = _pipeline(spark, GOLDEN)
    for i, (s_in, v_in, s_out, v_out, s_num, v_num) in enumerate(GOLDEN):
        r = got[i]
        assert (r.suma, r.indemnizatie_variabila, r.suma_num, r.indemnizatie_variabila_num) == (
            s_out, v_out, s_num, v_num), (s_in, v_in)


@pytest.mark.parametrize("text,expected", [
    (" 31 530 ", "31530"),
    ("12 000", "12000"),
    ("N/A", ""),
    ("  NU A FOST STABILITĂ ", ""),
    ("1/2/3", "3"),
    ("007+003", "10"),
    ("abc", ""),
    ("99999999999999999999+1", "100000000000000000000"),
])
def test_clean_amount_single_column(spark, text, expected):
    out = spark.createDataFrame([(text,)], "t string").select(clean_amount_text(F.col("t")).alias("o")).first().o
    assert out == expected


def test_single_expression_equals_staged(spark):
    rows = [(s,) for s, *_ in GOLDEN] + [(None,), ("  ",), ("1.000/2.000",)]
    df = spark.createDataFrame(rows, "suma string")
    single = [r.o for r in df.select(clean_amount_text(F.col("suma")).alias("o")).collect()]
    staged = [r.suma for r in cleaning.clean_amounts(df.withColumn("indemnizatie_variabila", F.lit(""))).collect()]
    assert single == staged


def test_digits_to_int(spark):
    df = spark.createDataFrame([("-500",), ("3.50",), ("",), (None,)], "t string")
    assert [r.o for r in df.select(digits_to_int(F.col("t")).alias("o")).collect()] == [500, 350, 0, 0]


def test_split_single_expression_equals_staged(spark):
    from salarium.functions.amounts import split_base_variable_cols
    from salarium.functions.text import normalize_seq_no_cell
    rows = [("5000 - 2000", "9"), ("-500", ""), ("a-b", "x"), ("1-2-3", None), (None, "7"), ("", "")]
    df = spark.createDataFrame(rows, "suma string, indemnizatie_variabila string")
    s, v = split_base_variable_cols(F.col("suma"), F.col("indemnizatie_variabila"))
    single = [(r.s, r.v) for r in df.select(s.alias("s"), v.alias("v")).collect()]
    staged = [(r.suma, r.indemnizatie_variabila) for r in cleaning.split_base_variable(df).collect()]
    assert single == staged
    nr = spark.createDataFrame([("12.0",), (" 7 ",), ("nan",), ("None",), (None,)], "n string")
    assert [r.o for r in nr.select(normalize_seq_no_cell(F.col("n")).alias("o")).collect()] == ["12", "7", "", "", ""]
