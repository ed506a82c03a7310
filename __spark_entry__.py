"""

Every query derives the raw disclosure table from the driver's tables (see
``salarium.sources.fixture``) and runs the pipeline over all of it; the warehouse stages a
query needs are built once per session and input folder (``salarium.plans.warehouse``).

A LIMIT appears only where it is the reference's feature, and the ranking still reads the
whole table: the top-k reports (``top_earners`` 50, ``top_earners_display`` 10,
``top10_directors`` 10), the first mappings of the sequence-number profile
(``seq_no_sample`` 5) and the review CLI's slices (``fact_slice`` 500,
``anomaly_flagged_slice`` 1,000). Every other anomaly and audit key reviews the whole fact.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# importable however this file is loaded (by path, from another working directory)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries  # noqa: E402

try:  # the training-data operators are an optional subpackage
    import corpus_pipeline
    from salarium.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None
from salarium.operators import analytics, anomaly, audit, cleaning, load, models, quality
from salarium.plans.warehouse import warehouse_for
from salarium.session import checkpoint_dir
from salarium.sources import files, fixture

SMOKE_DIR = "/root/testdata/sf0.001"


def _wh(spark: SparkSession, sf_dir: str):
    return warehouse_for(spark, sf_dir)


def _stage(spark, sf_dir, upto: str) -> DataFrame:
    return cleaning.prepare(fixture.raw_table(spark, sf_dir), upto)


def q_clean_text(spark, sf_dir):
    return _stage(spark, sf_dir, "text").select("src_row", "intreprindere", "personal")


def q_clean_placeholders(spark, sf_dir):
    return _stage(spark, sf_dir, "placeholders").select(
        "src_row", "autoritate_tutelara", "personal", "suma", "indemnizatie_variabila")


def q_split_base_variable(spark, sf_dir):
    return _stage(spark, sf_dir, "split").select("src_row", "suma", "indemnizatie_variabila")


def q_clean_amount_text(spark, sf_dir):
    return _stage(spark, sf_dir, "amounts").select("src_row", "suma", "indemnizatie_variabila")


def q_amount_numeric(spark, sf_dir):
    return _stage(spark, sf_dir, "numeric").select("src_row", "suma_num", "indemnizatie_variabila_num")


def q_infer_seq_no(spark, sf_dir):
    return _wh(spark, sf_dir).clean.select("src_row", "cui", "nr_crt")


def q_clean_reread(spark, sf_dir):
    return _wh(spark, sf_dir).clean_reread.select("src_row", *fixture.RAW_COLUMNS)


def q_load_typed(spark, sf_dir):
    return _wh(spark, sf_dir).loaded.select(
        "id", "nr_crt", "cui", "personal", "suma_num", "indemnizatie_variabila_num")


def q_stg(spark, sf_dir):
    return _wh(spark, sf_dir).stg


def q_int_base(spark, sf_dir):
    return _wh(spark, sf_dir).int_base.select("pk", "cui", "nume", "suma_clean", "variabila_clean", "total_plata")


def q_int_persons(spark, sf_dir):
    return _wh(spark, sf_dir).int_persons


def q_int_companies(spark, sf_dir):
    return _wh(spark, sf_dir).int_companies


def q_dim_persons(spark, sf_dir):
    return _wh(spark, sf_dir).dim_persons


def q_dim_companies(spark, sf_dir):
    return _wh(spark, sf_dir).dim_companies


def q_fact(spark, sf_dir):
    return _wh(spark, sf_dir).fact


def q_fact_deduped(spark, sf_dir):
    return _wh(spark, sf_dir).fact_deduped


def q_top_companies_raw(spark, sf_dir):
    return analytics.spend_by_company_raw(_wh(spark, sf_dir).loaded)


def q_avg_comp_members(spark, sf_dir):
    return analytics.avg_comp_by_company(_wh(spark, sf_dir).loaded, "%membru%")


def q_personnel_total_comp(spark, sf_dir):
    return analytics.personnel_total(_wh(spark, sf_dir).loaded)


def q_top10_directors(spark, sf_dir):
    return analytics.top_by_role(_wh(spark, sf_dir).loaded, "%director%", 10)


def q_distribution_companies(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.distribution(wh.fact, wh.dim_companies)


def q_org_pay_spread(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.pay_spread(wh.fact, wh.dim_companies)


def q_top_companies_spend(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.spend_by_company(wh.fact, wh.dim_companies)


def q_yearly_evolution(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.yearly_evolution(wh.fact, wh.dim_companies)


def q_top_earners(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.top_earners(wh.fact, wh.dim_persons, 50)


def q_top_earners_display(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return analytics.top_earners_display(analytics.top_earners(wh.fact, wh.dim_persons, 50), 10)


def q_duplicate_contracts(spark, sf_dir):
    return analytics.duplicate_contracts(_wh(spark, sf_dir).fact)


# ---- quality ---------------------------------------------------------------------------


def q_names_multi_company(spark, sf_dir):
    return quality.names_multi_company(_wh(spark, sf_dir).clean_reread)


def q_missing_critical_rows(spark, sf_dir):
    return quality.missing_critical(_wh(spark, sf_dir).clean_reread)


def q_quality_report(spark, sf_dir):
    return quality.quality_report(_wh(spark, sf_dir).clean_reread)


def q_seq_no_profile(spark, sf_dir):
    return quality.seq_no_profile(_wh(spark, sf_dir).before_inference)


def q_seq_no_sample(spark, sf_dir):
    return quality.seq_no_sample(_wh(spark, sf_dir).before_inference, 5)


def q_amounts_over_int_range(spark, sf_dir):
    return quality.amounts_over_int_range(_wh(spark, sf_dir).loaded)


def q_lost_identifiers(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.lost_identifiers(wh.raw, wh.clean)


def q_expect_not_null(spark, sf_dir):
    return quality.not_null_checks(_wh(spark, sf_dir))


def q_expect_unique(spark, sf_dir):
    return quality.unique_checks(_wh(spark, sf_dir))


def q_expect_relationships(spark, sf_dir):
    return quality.relationship_checks(_wh(spark, sf_dir))


def q_expect_earners_in_dim(spark, sf_dir):
    return quality.singular_checks(_wh(spark, sf_dir))


# parents with rows removed: the relationship checks must find what hangs loose
KEPT_PERSONS, KEPT_COMPANIES = "person_id >= '4'", "company_id NOT LIKE '%7'"


def q_expect_relationships_gaps(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    persons = quality.expect_relationship(
        wh.fact, "fact_indemnizatii", "person_id", wh.dim_persons.where(KEPT_PERSONS), "dim_persoane", "person_id")
    return persons.unionAll(quality.expect_relationship(
        wh.fact, "fact_indemnizatii", "company_id", wh.dim_companies.where(KEPT_COMPANIES), "dim_companii", "company_id"))


def q_expect_earners_gaps(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.expect_earners_in_dim(analytics.top_earners(wh.fact, wh.dim_persons), wh.dim_persons.where(KEPT_PERSONS))


# ---- anomaly review and audit --------------------------------------------------------------

RUN_ID = "20250101T000000Z"
SOURCE_TABLE = "analytics.fact_indemnizatii"


def _whole_slice(spark, sf_dir):
    return anomaly.fact_slice(_wh(spark, sf_dir).fact, None, None)


def _score_out(df):
    return df.select("record_pk", "company_id", "person_id", "anomaly_score",
                     F.array_join("anomaly_reasons", ";").alias("anomaly_reasons"))


def q_fact_slice(spark, sf_dir):
    return anomaly.fact_slice(_wh(spark, sf_dir).fact, None, 500)


def q_anomaly_peer_stats(spark, sf_dir):
    by_company, by_year, _ = _wh(spark, sf_dir).slice_stats(None, None)
    j = by_company.join(by_year, "year", "left")
    return j.select("year", "company_id", "mean", F.round("std", 2).alias("std"), "mean_y",
                    F.round("std_y", 2).alias("std_y"))


def q_anomaly_rules(spark, sf_dir):
    return _score_out(anomaly.anomaly_rules(_whole_slice(spark, sf_dir)))


def q_anomaly_scores(spark, sf_dir):
    return _score_out(_wh(spark, sf_dir).scores(None, None))


def _signed_slice(spark, sf_dir):
    """The whole fact as a source that keeps signs and gaps would deliver it (the cleaning of
    this one drops both): some amounts negative, some totals missing or zero."""
    sl, pk = _whole_slice(spark, sf_dir), F.col("record_pk").cast("bigint")
    total = F.when(pk % 19 == 0, F.lit(None)).when(pk % 23 == 0, -F.col("total_ron")).when(pk % 29 == 0, F.lit(0)).otherwise(F.col("total_ron"))
    return sl.withColumns({
        "suma_clean": F.when(pk % 13 == 0, -F.col("suma_clean")).otherwise(F.col("suma_clean")),
        "variabila_clean": F.when(pk % 17 == 0, -F.col("variabila_clean")).otherwise(F.col("variabila_clean")),
        "total_ron": total.cast("bigint")})


def q_anomaly_signed_labels(spark, sf_dir):
    scored = anomaly.anomaly_scores(_signed_slice(spark, sf_dir)).where("anomaly_score >= 0.5")
    return anomaly.classify_offline(scored).select(
        "record_pk", "company_id", "person_id", "anomaly_score", F.array_join("anomaly_reasons", ";").alias("anomaly_reasons"),
        "label", "confidence", "rationale")


def _flagged(spark, sf_dir):
    return _wh(spark, sf_dir).flagged(None, None, 3.0)


def q_anomaly_flagged(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "record_pk", "company_id", "person_id", "anomaly_score",
        F.array_join("anomaly_reasons", ";").alias("anomaly_reasons"), "total_ron")


def q_anomaly_flagged_slice(spark, sf_dir):
    # the review CLI's own slice semantics: statistics over the first 1,000 rows (README example)
    f = _wh(spark, sf_dir).flagged(None, 1000, 0.5)
    return f.select("record_pk", "company_id", "person_id", "anomaly_score",
                    F.array_join("anomaly_reasons", ";").alias("anomaly_reasons"), "total_ron")


def q_anomaly_queue_csv(spark, sf_dir):
    return audit.queue_for_csv(_flagged(spark, sf_dir))


def _candidates(spark, sf_dir):
    return _wh(spark, sf_dir).candidates(RUN_ID, SOURCE_TABLE, None, None, 3.0)


def q_anomaly_labels(spark, sf_dir):
    return anomaly.classify_offline(_candidates(spark, sf_dir)).select(
        "record_pk", "label", "confidence", "rationale", "reviewer_type", "model")


def q_prompt_fingerprint(spark, sf_dir):
    return anomaly.prompt_fingerprint(_candidates(spark, sf_dir)).select("record_pk", "prompt_sha256")


def q_audit_candidates(spark, sf_dir):
    c = _candidates(spark, sf_dir)
    return c.select(*[F.array_join(x, ";").alias(x) if x == "anomaly_reasons" else F.col(x)
                      for x in audit.CANDIDATE_COLUMNS])


def q_audit_reviews(spark, sf_dir):
    return audit.reviews(_candidates(spark, sf_dir)).select(*audit.REVIEW_COLUMNS)


def q_audit_reviews_pruned(spark, sf_dir):
    c = _candidates(spark, sf_dir)
    r = audit.reviews(c).select(*audit.REVIEW_COLUMNS)
    kept = audit.delete_candidates(c, F.col("anomaly_score") >= 4.0)
    return audit.cascade_reviews(r, kept)


# ---- reports in their order (O1, O3, O5) ------------------------------------------------


def _report(name: str):
    def query(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        return analytics.ranked(name, analytics.all_reports(wh.loaded, wh.fact, wh.dim_companies)[name])

    return query


# ---- files: the raw table, or a stage of it, written and read again ----------------------

# Headers of the source file that normalise to the known names.
RAW_HEADERS = ["Nr.crt", "Autoritate Publică Tutelară (APT)", "Nume întreprindere publică", "CUI",
               "Nume personal conducere", "Calitate (membru CA/CS\ndirector/membru directorat)",
               "Valoare indemnizație fix lunar conform contract (brut-lei)*",
               "Valoare indemnizație variabila anual conform contract (brut-lei)*"]


def _folder_for(spark, name: str) -> str:
    """A new folder in the shared place."""
    return f"{checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


def q_raw_csv(spark, sf_dir):
    path = _folder_for(spark, "raw-csv")
    raw = fixture.raw_table(spark, sf_dir).select(*fixture.RAW_COLUMNS).toDF(*RAW_HEADERS)
    raw.write.options(**files.CSV_WRITE).option("header", True).csv(path)
    return files.read_raw(spark, path).select(*fixture.RAW_COLUMNS)


def q_malformed_records(spark, sf_dir):
    """A file record of two to five cells for every order, one of them quoted with a comma and
    quotes inside, under a header of three."""
    path, key = _folder_for(spark, "malformed"), F.col("o_orderkey")
    note = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(',""x"""'))
    record = F.concat_ws(",", key, F.when(key % 31 != 0, note), F.when(key % 37 == 0, F.lit("")),
                         F.when(key % 41 == 0, F.lit("more")), F.col("o_custkey"))
    lines = spark.read.parquet(f"{sf_dir}/orders.parquet").select(record.alias("k,note,c"))
    lines.write.options(sep="\t", quote="", header=True).csv(path)  # one column: its text stays as it is
    return files.malformed_records(spark, path).select("n_fields", "content")


def q_clean_csv(spark, sf_dir):
    path = _folder_for(spark, "clean-csv")
    files.write_clean(_wh(spark, sf_dir).clean, path)
    return files.read_clean(spark, path)


def q_validated_csv(spark, sf_dir):
    path = _folder_for(spark, "validated-csv")
    files.write_validated(_wh(spark, sf_dir).clean_reread, path)
    return files.read_clean(spark, path)


def q_published(spark, sf_dir):
    path = _folder_for(spark, "published")
    files.publish(_wh(spark, sf_dir).clean, path)
    return files.read_published(spark, path)


def q_reloaded(spark, sf_dir):
    """The state after two loads into one target is that of the second alone."""
    path, base = _folder_for(spark, "reloaded"), _wh(spark, sf_dir).int_base.select("pk", "cui", "total_plata")
    files.full_reload(base.where("total_plata > 0"), path)
    files.full_reload(base, path)
    return files.read_reloaded(spark, path)


def q_quality_history(spark, sf_dir):
    """Two runs' reports in one folder: the raw cells' and the cleaned cells'."""
    path, wh = _folder_for(spark, "quality"), _wh(spark, sf_dir)
    for step, df in (("before", wh.before_inference), ("after", wh.clean_reread)):
        files.write_quality_report(quality.quality_report(df), path, "raw", step)
    return spark.read.json(path).select("output_file", "row_count", "rows_with_missing_fields")


def q_drop_empty_rows(spark, sf_dir):
    """Every 17th row loses all its cells, every 19th all but one."""
    raw, k = fixture.raw_table(spark, sf_dir), F.col("src_row")
    gaps = raw.select("src_row", *[
        F.when((k % 17 == 0) | ((k % 19 == 0) & F.lit(c != "cui")), F.lit(None)).otherwise(F.col(c)).alias(c)
        for c in fixture.RAW_COLUMNS])
    return cleaning.drop_empty_rows(gaps).select("src_row", "cui", "personal")


def q_staging_load_time(spark, sf_dir):
    loaded = load.as_loaded(_wh(spark, sf_dir).clean, loaded_at=F.lit("2025-01-01 06:30:00").cast("timestamp"))
    return models.staging(loaded).select("pk", "nume", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": q_clean_text,
    "clean_placeholders": q_clean_placeholders,
    "split_base_variable": q_split_base_variable,
    "clean_amount_text": q_clean_amount_text,
    "amount_numeric": q_amount_numeric,
    "infer_seq_no": q_infer_seq_no,
    "clean_reread": q_clean_reread,
    "load_typed": q_load_typed,
    "stg_compensation": q_stg,
    "int_base": q_int_base,
    "int_persons": q_int_persons,
    "int_companies": q_int_companies,
    "dim_persons": q_dim_persons,
    "dim_companies": q_dim_companies,
    "fact": q_fact,
    "fact_deduped": q_fact_deduped,
    "top_companies_raw": q_top_companies_raw,
    "avg_comp_members": q_avg_comp_members,
    "personnel_total_comp": q_personnel_total_comp,
    "top10_directors": q_top10_directors,
    "distribution_companies": q_distribution_companies,
    "org_pay_spread": q_org_pay_spread,
    "top_companies_spend": q_top_companies_spend,
    "yearly_evolution": q_yearly_evolution,
    "top_earners": q_top_earners,
    "top_earners_display": q_top_earners_display,
    "duplicate_contracts": q_duplicate_contracts,
    "names_multi_company": q_names_multi_company,
    "missing_critical_rows": q_missing_critical_rows,
    "quality_report": q_quality_report,
    "seq_no_profile": q_seq_no_profile,
    "seq_no_sample": q_seq_no_sample,
    "lost_identifiers": q_lost_identifiers,
    "amounts_over_int_range": q_amounts_over_int_range,
    "expect_not_null": q_expect_not_null,
    "expect_unique": q_expect_unique,
    "expect_relationships": q_expect_relationships,
    "expect_earners_in_dim": q_expect_earners_in_dim,
    "expect_relationships_gaps": q_expect_relationships_gaps,
    "expect_earners_gaps": q_expect_earners_gaps,
    "fact_slice": q_fact_slice,
    "anomaly_peer_stats": q_anomaly_peer_stats,
    "anomaly_rules": q_anomaly_rules,
    "anomaly_scores": q_anomaly_scores,
    "anomaly_signed_labels": q_anomaly_signed_labels,
    "anomaly_flagged": q_anomaly_flagged,
    "anomaly_flagged_slice": q_anomaly_flagged_slice,
    "anomaly_queue_csv": q_anomaly_queue_csv,
    "anomaly_labels": q_anomaly_labels,
    "prompt_fingerprint": q_prompt_fingerprint,
    "audit_candidates": q_audit_candidates,
    "audit_reviews": q_audit_reviews,
    "audit_reviews_pruned": q_audit_reviews_pruned,
    **{f"report_{name}": _report(name) for name in analytics.REPORT_ORDER},
    "raw_csv": q_raw_csv,
    "malformed_records": q_malformed_records,
    "clean_csv": q_clean_csv,
    "validated_csv": q_validated_csv,
    "published": q_published,
    "reloaded": q_reloaded,
    "quality_history": q_quality_history,
    "drop_empty_rows": q_drop_empty_rows,
    "staging_load_time": q_staging_load_time,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top earners over the whole warehouse built from sf0.001."""
    return q_top_earners(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if llm_queries is not None:
        out.update(llm_queries.QUERIES)
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    sql = {k: v for k, v in oracle_queries.oracle_sql().items() if k in _QUERIES}
    if llm_queries is not None:
        sql.update(llm_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
