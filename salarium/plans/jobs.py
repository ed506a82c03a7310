"""The batch job: one raw CSV extract (or a folder of them) in; the cleaned artifacts, the
warehouse tables, the quality report, data-test results, diagnostics, the review queue,
the audit trail and a run record out.

Every step is a Spark job over the whole input; outputs are full reloads (their state
depends only on the current input) except the audit tables, which are append-only.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from salarium.operators import analytics, anomaly, audit, models, quality
from salarium.plans.warehouse import Warehouse
from salarium.session import write_table
from salarium.sources import files
from salarium.sources.csv_records import land_records

SOURCE_TABLE = "analytics.fact_indemnizatii"


def run_batch(spark: SparkSession, raw_csv: str, out_dir: str, year: int = models.DEFAULT_YEAR,
              review_year: int | None = None, review_limit: int | None = None, min_score: float = 3.0,
              run_id: str | None = None, publish_to: str | None = None) -> dict:
    """Run clean -> validate -> load -> models -> analytics -> review on ``raw_csv``.

    Layout under ``out_dir``: ``clean/`` and ``validated/`` (CSV), ``quality/`` (one JSON
    object per run), ``warehouse/<table>/`` (Parquet, replaced each run), ``reports/<name>/``
    (the seven reports with their rank, replaced each run), ``published/indemnizatii_clean``
    or ``publish_to`` (the cleaned CSV in ordered parts, and the list of them), ``expectations/`` (one
    row per data test with its failure count), ``diagnostics/<name>/`` (malformed records,
    rows missing critical fields, names under several companies, lost identifiers, the
    sequence-number profile), ``artifacts/review_queue/`` (CSV),
    ``audit/candidates/`` and ``audit/reviews/`` (Parquet, appended), ``runs/`` (one JSON
    record per run with stage durations, appended). The review looks at
    ``review_year`` only when given and at the first ``review_limit`` rows when given.
    Returns a few counts of the run.
    """
    out = out_dir.rstrip("/")
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    durations: dict[str, float] = {}
    mark = time.perf_counter()

    def stage_done(name: str) -> None:
        nonlocal mark
        now = time.perf_counter()
        durations[name] = round(now - mark, 3)
        mark = now

    # all reloads stay under the configured prefixes, or else under the job's own folder
    guard = None if spark.conf.get(files.RELOAD_GUARD, None) else (f"{out}/",)
    landed = land_records(spark, raw_csv)
    raw = files.read_raw(spark, raw_csv, landed)
    quality.require_columns(raw)  # before any output is written
    bad_lines = files.count_malformed(spark, raw_csv, landed)
    started = _dt.datetime.now(_dt.timezone.utc)
    wh = Warehouse(raw, year=year, loaded_at=F.lit(started))

    # clean artifact, validated export and the quality report
    files.write_clean(wh.clean, f"{out}/clean")
    counted = files.write_validated(wh.clean_reread, f"{out}/validated", quality.row_counts())
    report = quality.quality_report(wh.clean_reread, bad_lines, counted)
    files.write_quality_report(report, f"{out}/quality", raw_csv, f"{out}/validated")
    stage_done("clean_validate")

    # warehouse tables (full reload)
    tables = {
        "indemnizatii_clean": wh.loaded,
        "stg_indemnizatii_clean": wh.stg,
        "fact_indemnizatii": wh.fact,
        "dim_persoane": wh.dim_persons,
        "dim_companii": wh.dim_companies,
        "distribution_companii": analytics.distribution(wh.fact, wh.dim_companies),
        "organization_pay_spread": analytics.pay_spread(wh.fact, wh.dim_companies),
        "top_companii_by_spend": analytics.spend_by_company(wh.fact, wh.dim_companies),
        "top_earners": analytics.top_earners(wh.fact, wh.dim_persons),
        "yearly_salary_evolution": analytics.yearly_evolution(wh.fact, wh.dim_companies),
        "duplicate_person_contracts": analytics.duplicate_contracts(wh.fact),
    }
    for name, df in tables.items():
        files.full_reload(df, f"{out}/warehouse/{name}", guard)
    # the reports in their order, and the cleaned table under its stable key
    for name, df in analytics.all_reports(wh.loaded, wh.fact, wh.dim_companies).items():
        files.full_reload(analytics.ranked(name, df).orderBy("report_rank"), f"{out}/reports/{name}", guard)
    files.publish(wh.clean, publish_to or f"{out}/published/indemnizatii_clean")
    stage_done("load_models")

    # data tests over the models (failures are reported, not raised), and the diagnostics
    # the reference prints from its tool scripts, kept as tables
    files.full_reload(quality.all_checks(wh), f"{out}/expectations", guard)
    diagnostics = {
        "malformed_records": files.malformed_records(spark, raw_csv, landed),
        "missing_critical_rows": quality.missing_critical(wh.clean_reread),
        "names_multi_company": quality.names_multi_company(wh.clean_reread),
        "lost_identifiers": quality.lost_identifiers(raw, wh.clean),
        "seq_no_profile": quality.seq_no_profile(wh.before_inference),
    }
    for name, df in diagnostics.items():
        files.full_reload(df, f"{out}/diagnostics/{name}", guard)
    stage_done("data_tests")

    # anomaly review: queue artifact, then candidates and reviews (append-only)
    flagged = wh.flagged(review_year, review_limit, min_score)
    audit.export_review_queue(flagged, f"{out}/artifacts/review_queue")
    cands, reviews = audit.review_run(flagged, run_id, SOURCE_TABLE, f"{out}/audit/candidates",
                                      f"{out}/audit/reviews")
    stage_done("review")
    counts = spark.read.parquet(f"{out}/warehouse/indemnizatii_clean").agg(F.count(F.lit(1))).first()[0]
    summary = {
        "run_id": run_id,
        "bad_line_count": bad_lines,
        "loaded_rows": counts,
        "candidates": cands.count(),
        "reviews_total": reviews.count(),
        "failed_checks": spark.read.parquet(f"{out}/expectations").where(F.col("failures") > 0).count(),
        "duration_seconds": durations,
    }
    # one record per run, appended (the run log of the pipeline)
    record = spark.createDataFrame(
        [(run_id, raw_csv, counts, bad_lines, summary["candidates"], summary["failed_checks"], durations)],
        "run_id string, input_file string, loaded_rows long, bad_line_count long, candidates long, "
        "failed_checks long, duration_seconds map<string, double>")
    record.coalesce(1).write.mode("append").json(f"{out}/runs")
    return summary


def run_review(spark: SparkSession, fact_path: str, out_dir: str, year: int | None = None, limit: int | None = 500,
               min_score: float = 3.0, write_audit: bool = False, run_id: str | None = None) -> int:
    """Review a stored fact table on its own: the queue as CSV, and, only if asked for, the
    audit trail (candidates and reviews appended). Returns the number of flagged records."""
    out = out_dir.rstrip("/")
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    flagged = write_table(anomaly.review_queue(spark.read.parquet(fact_path), year, limit, min_score), "flagged")
    audit.export_review_queue(flagged, f"{out}/review_queue")
    if write_audit:
        audit.review_run(flagged, run_id, SOURCE_TABLE, f"{out}/audit/candidates", f"{out}/audit/reviews")
    return flagged.count()
