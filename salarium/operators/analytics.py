"""Analytics A1-A8, sorts O1-O5 and display helpers P17-P18.

Marts read the fact and the dimensions; the raw-table queries read the loaded table.
Ordering is applied at presentation only; tie-break columns make every LIMIT deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salarium.plans.percentile import exact_percentiles
from salarium.plans.sequence import with_sequence


def _company_names(dim_companies: DataFrame) -> DataFrame:
    return dim_companies.select(F.col("company_id").alias("_d_company_id"), "denumire")


def _with_company(pre: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """J3 on a pre-aggregated fact: inner join on ``company_id``. A company with several
    dimension rows multiplies its partial aggregates exactly as it would multiply rows."""
    d = _company_names(dim_companies)
    return pre.join(d, pre["company_id"] == d["_d_company_id"]).drop("_d_company_id")


def _company_year_totals(fact: DataFrame) -> DataFrame:
    """Eager aggregation before J3: per (year, company_id) sum and row count. Partial
    aggregation shrinks a company holding a third of the rows before any shuffle, and the
    join then sees one row per (year, company) instead of one per fact row."""
    return (fact.where(F.col("company_id").isNotNull())
                .groupBy("an_raportare", "company_id")
                .agg(F.sum("total_plata").alias("_sum"), F.count(F.lit(1)).alias("_n")))


def _company_year_values(fact: DataFrame) -> DataFrame:
    """Eager aggregation for order statistics: (year, company_id, value) -> row count."""
    return (fact.where(F.col("company_id").isNotNull())
                .groupBy("an_raportare", "company_id", "total_plata")
                .agg(F.count(F.lit(1)).alias("_w")))


def distribution(fact: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """A3: per (year, company name): avg, min, exact median, max, sum, count of rows.

    One distributed order-statistics pass over (value, count) pairs gives the median and the
    other measures together (``total_plata`` is never null in the fact, so counting values
    counts rows).
    """
    j = _with_company(_company_year_values(fact), dim_companies)
    d = exact_percentiles(j, ["an_raportare", "denumire"], "total_plata", {"median_salary": 0.5},
                          stats_prefix="s_", weight_col="_w")
    return d.select(
        "an_raportare", F.col("denumire").alias("companie"),
        (F.col("s_sum").cast("double") / F.col("s_total")).alias("avg_salary"),
        F.col("s_min").alias("lowest"), "median_salary", F.col("s_max").alias("highest"),
        F.col("s_sum").alias("total_spend"), F.col("s_total").alias("num_people"))


def pay_spread(fact: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """A4: per company name: max - min, exact p90 and p10 (all years together)."""
    j = _with_company(_company_year_values(fact), dim_companies)
    d = exact_percentiles(j, ["denumire"], "total_plata", {"p90": 0.9, "p10": 0.1},
                          stats_prefix="s_", weight_col="_w")
    return d.select("denumire", (F.col("s_max") - F.col("s_min")).alias("spread"), "p90", "p10")


def spend_by_company(fact: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """A5: total spend per (year, company name)."""
    j = _with_company(_company_year_totals(fact), dim_companies)
    return j.groupBy("an_raportare", F.col("denumire").alias("companie")).agg(F.sum("_sum").alias("total_spend"))


def yearly_evolution(fact: DataFrame, dim_companies: DataFrame) -> DataFrame:
    """Per (company name, year): sum, avg, row count (avg = sum / count over the same
    rows the join would produce)."""
    j = _with_company(_company_year_totals(fact), dim_companies)
    g = j.groupBy(F.col("denumire").alias("companie"), "an_raportare").agg(
        F.sum("_sum").alias("total_spend"), F.sum("_n").alias("num_people"))
    return g.select("companie", "an_raportare", "total_spend",
                    (F.col("total_spend").cast("double") / F.col("num_people")).alias("avg_salary"),
                    "num_people")


def earners(fact: DataFrame, dim_persons: DataFrame) -> DataFrame:
    """A6 before the limit: per (year, person_id, name) the sum of totals (J4 inner join).

    The fact is summed per (year, person_id) first; a person with several dimension rows
    multiplies that sum exactly as it would multiply the rows."""
    pre = (fact.where(F.col("person_id").isNotNull())
               .groupBy("an_raportare", "person_id").agg(F.sum("total_plata").alias("_sum")))
    d = dim_persons.select(F.col("person_id").alias("_d_person_id"), "nume_normalizat")
    j = pre.join(d, pre["person_id"] == d["_d_person_id"])
    return j.groupBy("an_raportare", "person_id", F.col("nume_normalizat").alias("persoana")).agg(
        F.sum("_sum").alias("total_salary"))


def top_earners(fact: DataFrame, dim_persons: DataFrame, n: int = 50) -> DataFrame:
    """A6 + O4: top ``n`` overall (not per year), ties broken by year, id, name."""
    return (earners(fact, dim_persons)
            .orderBy(F.desc("total_salary"), "an_raportare", "person_id", "persoana")
            .limit(n))


def top_earners_display(top: DataFrame, n: int = 10) -> DataFrame:
    """P17 + O4: the first ``n`` rows of the top list with thousands separators."""
    return (top.orderBy(F.desc("total_salary"), "an_raportare", "person_id", "persoana")
               .limit(n)
               .select(F.col("an_raportare").alias("reporting_year"),
                       F.col("persoana").alias("person"),
                       F.format_number(F.col("total_salary"), 0).alias("total_salary_ron")))


def duplicate_contracts(fact: DataFrame) -> DataFrame:
    """A8 + F7: (company_id, person_id) pairs with more than one fact row; null keys group."""
    return (fact.groupBy("company_id", "person_id").agg(F.count(F.lit(1)).alias("num_rows"))
                .where(F.col("num_rows") > 1))


# ---- queries on the loaded (raw) table -------------------------------------------------


def avg_comp_by_company(loaded: DataFrame, role_like: str = "%membru%") -> DataFrame:
    """F1 + A1 + O3: mean base pay per enterprise over rows whose role matches."""
    return (loaded.where(F.col("calitate_membru").ilike(role_like))
                  .groupBy("intreprindere")
                  .agg(F.avg("suma_num").alias("avg_monthly_compensation")))


def personnel_total(loaded: DataFrame) -> DataFrame:
    """P18 + O1: per row total without coalescing (null if either amount is null)."""
    return loaded.select(
        "personal", "autoritate_tutelara", "intreprindere",
        (F.col("suma_num") + F.col("indemnizatie_variabila_num")).alias("total_compensation"))


def top_by_role(loaded: DataFrame, role_like: str = "%director%", n: int = 10) -> DataFrame:
    """F2 + O2: top ``n`` rows by total, nulls first (as PostgreSQL sorts DESC), ties by id."""
    total = F.col("suma_num") + F.col("indemnizatie_variabila_num")
    return (loaded.where(F.col("calitate_membru").ilike(role_like))
                  .select("id", "personal", "intreprindere", "suma_num", "indemnizatie_variabila_num",
                          total.alias("total_compensation"))
                  .orderBy(F.col("total_compensation").desc_nulls_first(), "id")
                  .limit(n)
                  .drop("id"))


def spend_by_company_raw(loaded: DataFrame) -> DataFrame:
    """A2 + O3: ``SUM(base) + SUM(variable)`` per enterprise (null if either sum is null)."""
    return loaded.groupBy("intreprindere").agg(
        (F.sum("suma_num") + F.sum("indemnizatie_variabila_num")).alias("total_spend"))


# ---- presentation order (O1, O3, O5) ----------------------------------------------------
# The reference's ORDER BY per report; PostgreSQL puts NULLs first on DESC. Applied only
# when a report is presented (a global sort is a range shuffle), never inside models.
REPORT_ORDER = {
    "distribution_companies": [("total_spend", "desc")],
    "org_pay_spread": [("spread", "desc")],
    "top_companies_spend": [("total_spend", "desc")],
    "yearly_evolution": [("companie", "asc"), ("an_raportare", "desc")],
    "personnel_total_comp": [("total_compensation", "desc")],
    "top_companies_raw": [("total_spend", "desc")],
    "avg_comp_members": [("avg_monthly_compensation", "desc")],
}


def report_order(report: str, columns: list[str]) -> list:
    """The report's sort keys, then its other columns, so that rows which differ have one order."""
    keys = [F.col(c).desc_nulls_first() if d == "desc" else F.col(c).asc_nulls_last() for c, d in REPORT_ORDER[report]]
    named = {c for c, _ in REPORT_ORDER[report]}
    return keys + [F.col(c).asc_nulls_first() for c in columns if c not in named]


def presented(report: str, df: DataFrame) -> DataFrame:
    """``df`` in the order the reference's report uses (NULLs first on DESC, last on ASC)."""
    return df.orderBy(*report_order(report, df.columns))


def ranked(report: str, df: DataFrame) -> DataFrame:
    """``df`` with ``report_rank`` = 1, 2, ... in the report's order: the order becomes data, so
    it survives a folder of files. Numbered over range partitions, not by a window in one task."""
    return with_sequence(df, report_order(report, df.columns), "report_rank")


def all_reports(loaded: DataFrame, fact: DataFrame, dim_companies: DataFrame) -> dict[str, DataFrame]:
    """The seven ordered reports by name, unordered (see ``ranked``)."""
    return {
        "distribution_companies": distribution(fact, dim_companies),
        "org_pay_spread": pay_spread(fact, dim_companies),
        "top_companies_spend": spend_by_company(fact, dim_companies),
        "yearly_evolution": yearly_evolution(fact, dim_companies),
        "personnel_total_comp": personnel_total(loaded),
        "top_companies_raw": spend_by_company_raw(loaded),
        "avg_comp_members": avg_comp_by_company(loaded),
    }
