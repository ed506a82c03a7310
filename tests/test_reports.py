"""Reports in their order, the load's timestamp in staging, and the published artifact."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from salarium.operators import analytics, load, models
from salarium.plans.jobs import run_batch
from salarium.sources import files
from tests.test_job import _write_raw


def test_rank_follows_the_report(spark):
    rows = [(2025, "B", 5), (2025, None, None), (2025, "A", 5), (2024, "A", 9), (2025, None, None)]
    df = spark.createDataFrame(rows, "an_raportare int, companie string, total_spend long").repartition(3)
    got = {(r.report_rank, r.an_raportare, r.companie, r.total_spend) for r in analytics.ranked("top_companies_spend", df).collect()}
    assert got == {(1, 2025, None, None), (2, 2025, None, None), (3, 2024, "A", 9), (4, 2025, "A", 5), (5, 2025, "B", 5)}
    evolution = analytics.ranked("yearly_evolution", df)
    got = [(r.companie, r.an_raportare) for r in evolution.orderBy("report_rank").collect()]
    assert got == [("A", 2025), ("A", 2024), ("B", 2025), (None, 2025), (None, 2025)]  # nulls last on ascending names
    assert analytics.ranked("top_companies_spend", df.limit(0)).count() == 0


def test_rank_needs_no_single_task_window(spark):
    df = spark.range(100).select(F.col("id").alias("total_spend"), F.lit("x").alias("intreprindere"))
    plan = analytics.ranked("top_companies_raw", df)._jdf.queryExecution().executedPlan().toString()
    window = plan.split("Window ")[1].split("\n")[0]
    assert plan.count("Window ") == 1 and "_seq_part" in window  # only over the counts of the partitions


def test_load_time_reaches_staging(spark):
    cells = {c: "" for c in load.LOAD_COLUMNS} | {"suma_num": 1, "indemnizatie_variabila_num": 2}
    clean = spark.createDataFrame([{"src_row": 1, **cells}])
    row = models.staging(load.as_loaded(clean, loaded_at=F.to_timestamp(F.lit("2025-01-02 03:04:05")))).first()
    assert str(row.created_at) == "2025-01-02 03:04:05" and row.pk == 1
    assert "created_at" not in models.staging(load.as_loaded(clean)).columns


def test_published_parts_are_listed_in_order(spark, tmp_dir):
    uri = os.path.join(tmp_dir, "key")
    df = spark.range(50).select(F.col("id").alias("src_row"), F.concat(F.lit('a,"\n'), F.col("id")).alias("c"), F.lit("").alias("e"))
    files.publish(df.repartition(7), uri)
    files.publish(df.repartition(5), uri)  # the key is stable: a second run replaces the first
    listed = spark.read.option("header", True).csv(f"{uri}.parts").orderBy("part").collect()
    paths = sorted(glob.glob(f"{uri}/part-*.csv"))
    assert [r.part for r in listed] == [os.path.basename(p) for p in paths]
    assert [int(r.bytes) for r in listed] == [os.path.getsize(p) for p in paths]
    # the parts in the list's order, without their headers, are the table in file order
    body = "".join(open(p, encoding="utf-8", newline="").read().removeprefix("c,e\n") for p in paths)
    assert body == "".join(f'"a,""\n{i}",\n' for i in range(50))
    back = files.read_published(spark, uri)
    assert sorted((r.c, r.e) for r in back.collect()) == sorted((f'a,"\n{i}', "") for i in range(50))
    with open(paths[-1], "a", encoding="utf-8") as f:
        f.write("late,x\n")
    with pytest.raises(RuntimeError, match="parts"):
        files.read_published(spark, uri)


def test_job_writes_reports_staging_and_artifact(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw.csv"), os.path.join(tmp_dir, "out")
    _write_raw(raw)
    run_batch(spark, raw, out, run_id="r1", min_score=1.0)
    for name, order in analytics.REPORT_ORDER.items():
        rows = spark.read.parquet(f"{out}/reports/{name}").orderBy("report_rank").collect()
        assert [r.report_rank for r in rows] == list(range(1, len(rows) + 1)) and rows
        first, way = order[0]
        values = [r[first] for r in rows if r[first] is not None]
        assert values == sorted(values, reverse=way == "desc")
    stg = spark.read.parquet(f"{out}/warehouse/stg_indemnizatii_clean")
    loaded = spark.read.parquet(f"{out}/warehouse/indemnizatii_clean")
    assert stg.select("created_at").distinct().collect() == loaded.select("created_at").distinct().collect()
    assert stg.select("created_at").distinct().count() == 1 and stg.where("created_at IS NULL").count() == 0
    published = files.read_published(spark, f"{out}/published/indemnizatii_clean")
    clean = files.read_clean(spark, f"{out}/clean")
    assert published.columns == clean.columns and published.count() == 60


def test_counts_taken_while_writing(spark, tmp_dir):
    from salarium.operators import quality

    columns = [*quality.CRITICAL_COLUMNS, "nr_crt"]
    blank = lambda c, i: "" if (c == "cui" and i % 7 == 0) or (c == "nr_crt" and i % 3 == 0) else f"{c}{i % 4}"
    rows = [(i, *[blank(c, i) for c in columns]) for i in range(500)]
    df = spark.createDataFrame(rows, "src_row long, " + ", ".join(f"{c} string" for c in columns)).repartition(6)
    counted = files.write_validated(df, os.path.join(tmp_dir, "v"), quality.row_counts())
    assert counted == {"row_count": 500, "rows_with_missing_fields": 72, "blank_nr_crt": 167}
    assert quality.quality_report(df, 3, counted).collect() == quality.quality_report(df, 3).collect()
    empty = files.write_validated(df.limit(0), os.path.join(tmp_dir, "e"), quality.row_counts())
    assert quality.quality_report(df.limit(0), 0, empty).collect() == quality.quality_report(df.limit(0)).collect()
