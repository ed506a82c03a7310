"""Command line: the batch job, ``python -m salarium RAW_CSV OUT_DIR [options]``, and the review
of a stored fact table, ``python -m salarium review FACT OUT_DIR [options]``.

Uses the active session when there is one (spark-submit), else a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from salarium.operators.models import DEFAULT_YEAR
from salarium.plans.jobs import run_batch, run_review
from salarium.session import apply_defaults, build_session


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return build_session()
    apply_defaults(spark)
    return spark


def review(argv: list[str]) -> dict:
    p = argparse.ArgumentParser(prog="salarium review", description="Review a stored fact table.")
    p.add_argument("fact", help="fact table (Parquet)")
    p.add_argument("out_dir", help="folder for the queue and the audit trail")
    p.add_argument("--year", type=int, default=None, help="review only this year")
    p.add_argument("--limit", type=int, default=500, help="review the first N rows (year desc, pk); 0: all")
    p.add_argument("--min-score", type=float, default=3.0, help="flag rows scoring at least this")
    p.add_argument("--write-audit", action="store_true", help="append candidates and reviews")
    p.add_argument("--run-id", default=None, help="audit run id (default: UTC timestamp)")
    args = p.parse_args(argv)
    flagged = run_review(_session(), args.fact, args.out_dir, year=args.year, limit=args.limit or None,
                         min_score=args.min_score, write_audit=args.write_audit, run_id=args.run_id)
    print(json.dumps({"flagged": flagged}))
    return {"flagged": flagged}


def main(argv: list[str] | None = None) -> dict:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["review"]:
        return review(argv[1:])
    p = argparse.ArgumentParser(prog="salarium", description=__doc__)
    p.add_argument("raw_csv", help="raw extract (CSV, header row, quoted multi-line cells)")
    p.add_argument("out_dir", help="folder for artifacts, warehouse tables and audit trail")
    p.add_argument("--year", type=int, default=DEFAULT_YEAR, help="reporting year of the fact")
    p.add_argument("--review-year", type=int, default=None, help="review only this year")
    p.add_argument("--review-limit", type=int, default=None, help="review the first N rows (year desc, pk)")
    p.add_argument("--min-score", type=float, default=3.0, help="flag rows scoring at least this")
    p.add_argument("--run-id", default=None, help="audit run id (default: UTC timestamp)")
    args = p.parse_args(argv)

    spark = _session()
    summary = run_batch(spark, args.raw_csv, args.out_dir, year=args.year, review_year=args.review_year,
                        review_limit=args.review_limit, min_score=args.min_score, run_id=args.run_id)
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
