"""Cleaning P1-P10 on hand-built rows."""

from pyspark.sql import functions as F

from salarium.functions.text import WHITESPACE, py_strip
from salarium.operators import cleaning


def test_normalize_column_names():
    f = cleaning.normalize_column_name
    assert f("Nr.\nCrt") == "nr._crt"
    assert f("Autoritate Publică Tutelară (APT)") == "autoritate_public_tutelar_(apt)"
    assert f("  CUI  ") == "cui"
    assert f("Valoare  indemnizație fix lunar conform contract (brut-lei)*") == \
        "valoare_indemnizaie_fix_lunar_conform_contract_(brut-lei)*"


def test_rename_source_keeps_unknown(spark):
    df = spark.createDataFrame([("1", "x")], "`nr.crt` string, other string")
    assert cleaning.rename_source(df).columns == ["nr_crt", "other"]


def test_drop_empty_rows_keeps_blank_strings(spark):
    df = spark.createDataFrame([(1, "", ""), (2, None, None), (3, "a", None)], "src_row long, a string, b string")
    assert sorted(r.src_row for r in cleaning.drop_empty_rows(df).collect()) == [1, 3]


def test_strip_matches_python(spark):
    samples = ["  a b  ", " x　", "\x1cy\x1f", "\n\tz\r", "", "   ", "a​b"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r.o for r in df.select(py_strip(F.col("t")).alias("o")).collect()]
    assert got == [s.strip() for s in samples]
    assert all(ch.isspace() for ch in WHITESPACE)


def test_clean_text_and_placeholders(spark):
    df = spark.createDataFrame(
        [(1, "  Compania 3\nBUILDING ", "-"), (2, "x\r\n\r\ny", "NULL"), (3, "null", " N/A ")],
        "src_row long, a string, b string")
    out = {r.src_row: r for r in cleaning.blank_placeholders(cleaning.clean_text(df)).collect()}
    assert out[1].a == "Compania 3 BUILDING" and out[1].b == ""
    assert out[2].a == "x y" and out[2].b == ""
    assert out[3].a == "" and out[3].b == ""  # stripped before the exact match


def test_seq_no_normalisation_and_inference(spark):
    rows = [
        (1, "", "RO1"),        # filled from row 2 (first non-blank for RO1)
        (2, "5.0", "RO1"),
        (3, "7", "RO1"),       # a later, conflicting number does not win
        (4, "", "RO2"),        # no mapping -> ''
        (5, "nan", ""),        # 'nan' is blank
        (6, "9", ""),          # blank cui is a key like any other
        (7, "", ""),
        (8, "None", "RO3"),
    ]
    df = spark.createDataFrame(rows, "src_row long, nr_crt string, cui string")
    out = {r.src_row: r.nr_crt for r in cleaning.infer_seq_no(cleaning.normalize_seq_no(df)).collect()}
    assert out == {1: "5", 2: "5", 3: "7", 4: "", 5: "9", 6: "9", 7: "9", 8: ""}


def test_clean_is_idempotent_on_text(spark):
    df = spark.createDataFrame([(1, " a\nb ", "N/A"), (2, "c", " d ")], "src_row long, x string, y string")
    once = cleaning.blank_placeholders(cleaning.clean_text(df))
    twice = cleaning.blank_placeholders(cleaning.clean_text(once))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_report_order_nulls_first(spark):
    from salarium.operators.analytics import presented
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9)], "personal string, total_compensation long")
    assert [r.personal for r in presented("personnel_total_comp", df).collect()] == ["b", "c", "a"]


def test_missing_critical_strip_variants(spark):
    from salarium.operators.quality import missing_critical
    cols = ["a", "b"]
    df = spark.createDataFrame([(1, " ", "x"), (2, "", "y"), (3, "p", "q")], "src_row long, a string, b string")
    assert sorted(r.src_row for r in missing_critical(df, cols).collect()) == [1, 2]
    assert sorted(r.src_row for r in missing_critical(df, cols, strip=False).collect()) == [2]


def test_amounts_over_int_range(spark):
    from salarium.operators.quality import amounts_over_int_range
    df = spark.createDataFrame([(1, 5, 2**31), (2, 2**31 - 1, 0)], "id long, suma_num long, indemnizatie_variabila_num long")
    assert [r.id for r in amounts_over_int_range(df).collect()] == [1]


def test_load_timestamp_is_one_per_load(spark):
    from salarium.operators.load import LOAD_COLUMNS, as_loaded
    rows = [(i, str(i), "a", "b", "c", "d", "e", "1", "", 1, 0) for i in range(1, 30)]
    df = spark.createDataFrame(rows, "src_row long, " + ", ".join(
        f"{c} {'bigint' if c.endswith('_num') else 'string'}" for c in LOAD_COLUMNS))
    out = as_loaded(df, with_timestamp=True)
    assert out.select("created_at").distinct().count() == 1
    assert sorted(r.id for r in out.collect()) == list(range(1, 30))
    assert out.where("indemnizatie_variabila IS NULL").count() == 29   # '' loads as NULL


def test_required_columns_fail_the_run(spark):
    import pytest
    from salarium.operators.quality import quality_report
    df = spark.createDataFrame([(1, "x")], "src_row long, personal string")
    with pytest.raises(ValueError, match="required columns are absent"):
        quality_report(df)
