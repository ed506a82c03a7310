"""Audit trail S13, S15, S16, J10, X7: review queue artifact, candidates, reviews.

Ids continue from the largest id already stored and follow (score desc, record id), which
needs a global order; it is assigned with the distributed sequence (range partitioning plus
per-partition offsets), never with a single-partition window.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salarium.operators.anomaly import classify_offline, ordered_queue, prompt_fingerprint, reasons_text
from salarium.plans.sequence import with_sequence
from salarium.sources.files import CSV_WRITE

CANDIDATE_COLUMNS = ["candidate_id", "run_id", "source_table", "record_pk", "year", "company_id",
                     "person_id", "total_ron", "anomaly_score", "anomaly_reasons"]
REVIEW_COLUMNS = ["review_id", "candidate_id", "reviewer_type", "model", "prompt_sha256", "label",
                  "confidence", "rationale", "raw_response_json"]


def queue_for_csv(flagged: DataFrame) -> DataFrame:
    """Flagged rows as written to the CSV artifact (reasons as list text)."""
    return flagged.withColumn("anomaly_reasons", reasons_text(F.col("anomaly_reasons")))


def export_review_queue(flagged: DataFrame, path: str) -> None:
    """S13 + O7: write the review queue as CSV with a header, highest score first."""
    (queue_for_csv(ordered_queue(flagged)).write.mode("overwrite")
        .options(**CSV_WRITE).option("header", True).csv(path))


def _max_id(existing: DataFrame | None, column: str) -> int:
    if existing is None:
        return 0
    v = existing.agg(F.max(column)).first()[0]
    return int(v) if v is not None else 0


def candidates(flagged: DataFrame, run_id: str, source_table: str,
               existing: DataFrame | None = None, with_timestamp: bool = False, start: int | None = None) -> DataFrame:
    """Candidate rows with ids after the stored ones (or from ``start``), ordered by
    score desc, record id."""
    start = _max_id(existing, "candidate_id") + 1 if start is None else start
    rows = flagged.select(
        F.lit(run_id).alias("run_id"), F.lit(source_table).alias("source_table"), "record_pk",
        F.col("year").cast("int").alias("year"), "company_id", "person_id",
        F.col("total_ron").try_cast("double").alias("total_ron"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"), "anomaly_reasons",
        "suma_clean", "variabila_clean")
    numbered = with_sequence(rows, [F.desc("anomaly_score"), F.asc("record_pk")], "candidate_id", start)
    if with_timestamp:
        numbered = numbered.withColumn("created_at", F.current_timestamp())
    return numbered


def reviews(cands: DataFrame, existing: DataFrame | None = None, with_timestamp: bool = False) -> DataFrame:
    """S16 (+X5, X6): one offline review per candidate, keyed by ``candidate_id``.

    Review ids follow candidate ids, so they come from the candidate id itself (no second
    global ordering): ``review_id = last stored review id + (candidate_id - first new candidate id) + 1``.
    """
    start = _max_id(existing, "review_id")
    first = cands.agg(F.min("candidate_id")).first()[0] or 1
    labelled = prompt_fingerprint(classify_offline(cands))
    out = labelled.select(
        (F.lit(start) + F.col("candidate_id") - F.lit(first) + F.lit(1)).cast("bigint").alias("review_id"),
        "candidate_id", "reviewer_type", "model", "prompt_sha256", "label", "confidence", "rationale",
        F.lit(None).cast("string").alias("raw_response_json"))
    if with_timestamp:
        out = out.withColumn("reviewed_at", F.current_timestamp())
    return out


def delete_candidates(cands: DataFrame, keep: F.Column) -> DataFrame:
    """Candidates that survive a deletion (rows where ``keep`` holds)."""
    return cands.where(keep)


def cascade_reviews(reviews_df: DataFrame, remaining_candidates: DataFrame) -> DataFrame:
    """Reviews whose candidate still exists (ON DELETE CASCADE as a semi join)."""
    return reviews_df.join(remaining_candidates.select("candidate_id"), "candidate_id", "left_semi")


def append(df: DataFrame, path: str) -> None:
    """S15/S16 sink: append-only Parquet table."""
    df.write.mode("append").parquet(path)


LEDGER = "run_id string, state string, first_id long, noted_at long"


def _note(spark, path: str, run_id: str, state: str, first_id: int) -> None:
    """One line in the run ledger; times order the lines of a run."""
    spark.createDataFrame([(run_id, state, first_id, time.time_ns())], LEDGER).coalesce(1).write.mode("append").parquet(path)


def _unfinished(spark, path: str, run_id: str) -> int | None:
    """First candidate id of the run if its last line in the ledger is not ``done``."""
    ledger = _read_if_exists(spark, path)
    if ledger is None:
        return None
    last = ledger.where(F.col("run_id") == run_id).agg(F.max(F.struct("noted_at", "state", "first_id"))).first()[0]
    return last["first_id"] if last and last["state"] != "done" else None


def review_run(flagged: DataFrame, run_id: str, source_table: str, candidates_path: str,
               reviews_path: str, ledger_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates are appended first, then one review per candidate.

    A ledger beside the candidates notes where a run's ids begin before anything is appended,
    and that it is done after everything is. A rerun of a run that ended in between takes up
    the same ids and appends only what is missing; any other run gets new ids.
    """
    spark = flagged.sparkSession
    ledger_path = ledger_path or candidates_path.rstrip("/") + "_ledger"
    existing_c = _read_if_exists(spark, candidates_path)
    existing_r = _read_if_exists(spark, reviews_path)
    first = _unfinished(spark, ledger_path, run_id)
    resumed = first is not None
    if not resumed:
        first = _max_id(existing_c, "candidate_id") + 1
        _note(spark, ledger_path, run_id, "started", first)
    cands = candidates(flagged, run_id, source_table, with_timestamp=True, start=first)
    own = (F.col("run_id") == run_id) & (F.col("candidate_id") >= first)
    if not (resumed and existing_c is not None and not existing_c.where(own).isEmpty()):
        append(cands.select(*CANDIDATE_COLUMNS, "created_at"), candidates_path)
    stored = spark.read.parquet(candidates_path).where(own)
    reviewed = resumed and existing_r is not None and not existing_r.join(
        stored.select("candidate_id"), "candidate_id", "left_semi").isEmpty()
    if not reviewed:
        revs = reviews(stored.join(cands.select("candidate_id", "suma_clean", "variabila_clean"), "candidate_id"),
                       existing_r, with_timestamp=True)
        append(revs, reviews_path)
    _note(spark, ledger_path, run_id, "done", first)
    return stored, spark.read.parquet(reviews_path)


def _read_if_exists(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # first run; any other failure must not restart the ids
            return None
        raise
