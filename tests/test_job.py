"""The batch job from a raw CSV file end to end."""

import csv
import glob
import json
import os

from pyspark.sql import functions as F

from salarium.plans.jobs import run_batch

HEADER = ["Nr.crt", "Autoritate Publică Tutelară (APT)", "Nume întreprindere publică", "CUI",
          "Nume personal conducere", "Calitate (membru CA/CS\ndirector/membru directorat)",
          "Valoare indemnizație fix lunar conform contract (brut-lei)*",
          "Valoare indemnizație variabila anual conform contract (brut-lei)*"]


def _write_raw(path):
    rows = []
    for i in range(60):
        cui = f"RO{i % 4}"
        company = f"Compania\n{i % 4}" if i % 10 else f"compania\n{i % 4}"   # a second spelling
        rows.append([str(i % 7) if i % 5 else "", "APT", company, cui, f" Persoana {i % 9}",
                     "Director" if i % 2 else "membru CA",
                     ["12 000", "500+500", "100/2000", "3000 - 200", "N/A", "2500000"][i % 6], "" if i % 3 else "50"])
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(rows)
        f.write('99,APT,X,RO1,Y,Z,1,2,3,4\n')   # over-long record: dropped, counted as malformed
    return rows


def test_run_batch(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw.csv")
    _write_raw(raw)
    out = os.path.join(tmp_dir, "out")
    summary = run_batch(spark, raw, out, run_id="r1", min_score=1.0)
    assert summary["bad_line_count"] == 1 and summary["loaded_rows"] == 60
    loaded = spark.read.parquet(f"{out}/warehouse/indemnizatii_clean")
    assert sorted(r.id for r in loaded.select("id").collect()) == list(range(1, 61))
    # '3000 - 200' was split into base and variable
    assert loaded.where(F.col("suma") == "3000").first().indemnizatie_variabila == "200"
    report = json.loads(open(glob.glob(f"{out}/quality/part-*.json")[0], encoding="utf-8").read())
    assert report["row_count"] == 60 and report["bad_line_count"] == 1 and report["column_count"] == 10
    assert spark.read.option("header", True).csv(f"{out}/clean").count() == 60
    assert summary["candidates"] > 0 and summary["reviews_total"] == summary["candidates"]
    # a second run replaces the warehouse and appends to the audit trail
    again = run_batch(spark, raw, out, run_id="r2", min_score=1.0)
    assert spark.read.parquet(f"{out}/warehouse/indemnizatii_clean").count() == 60
    assert again["reviews_total"] == 2 * summary["reviews_total"]
    runs = spark.read.json(f"{out}/runs")
    assert sorted(r.run_id for r in runs.collect()) == ["r1", "r2"]
    assert set(summary["duration_seconds"]) == {"clean_validate", "load_models", "data_tests", "review"}
    assert spark.read.parquet(f"{out}/diagnostics/malformed_records").count() == 1
    assert spark.read.parquet(f"{out}/diagnostics/seq_no_profile").first().rows == 60


def test_run_batch_expectations(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw.csv")
    _write_raw(raw)
    out = os.path.join(tmp_dir, "out")
    summary = run_batch(spark, raw, out, run_id="r1", review_year=2025, review_limit=40)
    checks = {r.check_name: r.failures for r in spark.read.parquet(f"{out}/expectations").collect()}
    assert len(checks) == 18 + 7 + 2 + 1
    assert checks["unique_dim_companii_company_id"] > 0   # several spellings per company (fan-out)
    assert summary["failed_checks"] == sum(1 for v in checks.values() if v > 0)


def test_command_line(spark, tmp_dir):
    from salarium.__main__ import main
    raw = os.path.join(tmp_dir, "raw.csv")
    _write_raw(raw)
    summary = main([raw, os.path.join(tmp_dir, "cli"), "--min-score", "2.5", "--run-id", "cli1"])
    assert summary["run_id"] == "cli1" and summary["loaded_rows"] == 60


def test_csv_path_equals_table_path(spark, tmp_dir):
    """The adapter's raw rows written as a CSV extract (original header texts, file order)
    and run through the file-based job give the same loaded table and fact as the queries
    over the driver's tables."""
    import __spark_entry__ as E
    from salarium.sources.fixture import RAW_COLUMNS, raw_table
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    rows = raw_table(spark, sf).orderBy("src_row").select(*RAW_COLUMNS).collect()
    raw = os.path.join(tmp_dir, "extract.csv")
    with open(raw, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows([list(r) for r in rows])
    out = os.path.join(tmp_dir, "out")
    run_batch(spark, raw, out, run_id="eq")

    def rows_of(df, cols):
        return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())

    fact_cols = ["pk", "person_id", "company_id", "total_plata", "suma_clean", "variabila_clean", "an_raportare"]
    assert rows_of(spark.read.parquet(f"{out}/warehouse/fact_indemnizatii"), fact_cols) == \
        rows_of(E.queries()["fact"](spark, sf), fact_cols)
    load_cols = ["id", "nr_crt", "cui", "personal", "suma_num", "indemnizatie_variabila_num"]
    assert rows_of(spark.read.parquet(f"{out}/warehouse/indemnizatii_clean"), load_cols) == \
        rows_of(E.queries()["load_typed"](spark, sf), load_cols)


def test_review_of_a_stored_fact(spark, tmp_dir):
    from salarium.plans.jobs import run_review

    rows = [(i, "p", "c", 100 + i, 100, i, 2025) for i in range(20)] + [(99, None, "", 5_000_000, 5_000_000, 0, 2025)]
    fact = spark.createDataFrame(rows, "pk long, person_id string, company_id string, total_plata long, "
                                       "suma_clean long, variabila_clean long, an_raportare int")
    fact.write.parquet(f"{tmp_dir}/fact")
    assert run_review(spark, f"{tmp_dir}/fact", f"{tmp_dir}/a", year=2025) == 1
    assert not os.path.exists(f"{tmp_dir}/a/audit")
    for n in (1, 2):  # the same run id twice: ids go on
        assert run_review(spark, f"{tmp_dir}/fact", f"{tmp_dir}/a", write_audit=True, run_id="r") == 1
        assert sorted(r.candidate_id for r in spark.read.parquet(f"{tmp_dir}/a/audit/candidates").collect()) == list(range(1, n + 1))
        assert sorted(r.review_id for r in spark.read.parquet(f"{tmp_dir}/a/audit/reviews").collect()) == list(range(1, n + 1))


def test_reload_keeps_the_old_state_when_a_run_fails(spark, tmp_dir):
    from pyspark.sql import functions as F

    from salarium.sources import files

    target = f"{tmp_dir}/t"
    files.full_reload(spark.range(3), target)
    try:
        files.full_reload(spark.range(5).withColumn("x", F.raise_error(F.lit("stop"))), target)
    except Exception:
        pass
    assert spark.read.parquet(target).count() == 3
