"""Data-quality operators V1-V8, A9, A11, A12, D4.

Each expectation returns one row per configured check (``check_name``, ``failures``);
zero failures means the check passes. Checks over the same model are computed in one
aggregation pass; results of different models are concatenated with ``unionByName``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.functions.text import is_blank, py_strip
from salarium.operators.cleaning import BOOKKEEPING, position, position_cols
from salarium.plans.joins import bounded, hinted
from salarium.session import materialize

# Columns that every disclosure must fill.
CRITICAL_COLUMNS = ["autoritate_tutelara", "intreprindere", "cui", "personal", "calitate_membru"]


def _concat(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def expect_not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """V1: null count per column, one pass over ``df``; rows ``not_null_<model>_<column>``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'not_null_{model}_{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (check_name, failures)")


def expect_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """V2: number of non-null values that occur more than once (nulls ignored)."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1))
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(f"unique_{model}_{column}").alias("check_name"), "failures")


def expect_relationship(child: DataFrame, child_model: str, fk: str, parent: DataFrame,
                        parent_model: str, pk: str) -> DataFrame:
    """V3: child rows whose non-null key has no parent row.

    The child keys are counted first and materialised (partial aggregation: a key held by a
    third of the rows becomes one row per partition), so only distinct keys meet the distinct
    parent keys; materialising also stops the optimizer from pushing the anti join back
    below the aggregation. The parent keys get a broadcast hint when they fit the bound.
    """
    parent_keys, fits = bounded(
        parent.select(F.col(pk).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct())
    parent_keys = hinted(parent_keys, fits)
    child_keys = materialize(child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_rows")))
    orphans = child_keys.join(parent_keys, F.col(fk) == F.col("_parent_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures")).select(
        F.lit(f"relationships_{child_model}_{fk}__{parent_model}_{pk}").alias("check_name"), "failures")


def earners_missing_from_dim(top: DataFrame, dim_persons: DataFrame) -> DataFrame:
    """V4 (J7): top-earner ids without a dimension row."""
    return top.select("person_id").join(dim_persons.select("person_id"), "person_id", "left_anti")


def expect_earners_in_dim(top: DataFrame, dim_persons: DataFrame) -> DataFrame:
    return earners_missing_from_dim(top, dim_persons).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("top_earners_person_id_exists_in_dim_persoane").alias("check_name"), "failures")


def require_columns(df: DataFrame, columns: list[str] = CRITICAL_COLUMNS) -> list[str]:
    """V5: names of required columns that are absent; raises when any is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are absent: {', '.join(missing)}")
    return missing


def _any_blank(columns: list[str]):
    return reduce(lambda a, b: a | b, [is_blank(F.col(c)) for c in columns])


def missing_critical(clean: DataFrame, columns: list[str] = CRITICAL_COLUMNS, strip: bool = True) -> DataFrame:
    """V6 (F6): rows with at least one critical column blank after strip (``strip=False``:
    exactly empty, the diagnostic variant)."""
    keep = [*position_cols(clean), *[c for c in columns if c in clean.columns]]
    if strip:
        cond = _any_blank(columns)
    else:
        cond = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == F.lit(""), F.lit(True)) for c in columns])
    return clean.where(cond).select(*keep)


def names_multi_company(clean: DataFrame) -> DataFrame:
    """A9 (P19): lower-cased stripped names under more than one stripped ``cui``."""
    named = clean.select(F.lower(py_strip(F.col("personal"))).alias("personal_clean"),
                         py_strip(F.col("cui")).alias("cui_clean"))
    named = named.where((F.col("personal_clean") != "") & (F.col("cui_clean") != ""))
    return (named.groupBy("personal_clean").agg(F.count_distinct("cui_clean").alias("n_cui"))
                 .where(F.col("n_cui") > 1))


def row_counts() -> list[Column]:
    """The counts of V7 that a single pass over the rows gives; they can be taken while the rows
    are written (``files.write_validated``)."""
    return [F.count(F.lit(1)).alias("row_count"),
            F.count_if(_any_blank(CRITICAL_COLUMNS)).alias("rows_with_missing_fields"),
            F.count_if(is_blank(F.col("nr_crt"))).alias("blank_nr_crt")]


def quality_report(clean: DataFrame, bad_line_count: int = 0, counted: dict[str, int] | None = None) -> DataFrame:
    """V7 (A11): one row of counts over the re-read clean table, plus ``status``.

    ``counted``: the values of ``row_counts``, where a write of ``clean`` has observed them; the
    table is then read for its names only.
    """
    data_cols = [c for c in clean.columns if c not in BOOKKEEPING]
    missing = require_columns(clean)
    if counted is None:
        counts = clean.agg(*row_counts())
    else:
        counts = clean.sparkSession.range(1).select(
            *[F.lit(counted[c]).cast("bigint").alias(c) for c in ("row_count", "rows_with_missing_fields", "blank_nr_crt")])
    counts = counts.select(
        "*",
        F.lit(None).cast("bigint").alias("names_with_multiple_cui_review_count"))
    names = names_multi_company(clean).agg(
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("bigint").alias("rows_with_missing_fields"),
        F.lit(None).cast("bigint").alias("blank_nr_crt"),
        F.count(F.lit(1)).alias("names_with_multiple_cui_review_count"))
    # two one-row results folded into one row without a cross join
    both = counts.unionByName(names).agg(*[F.max(c).alias(c) for c in counts.columns])
    return both.select(
        "row_count",
        F.lit(len(data_cols)).cast("bigint").alias("column_count"),
        F.lit(bad_line_count).cast("bigint").alias("bad_line_count"),
        F.lit("[" + ", ".join(missing) + "]").alias("missing_critical_columns"),
        "rows_with_missing_fields", "names_with_multiple_cui_review_count", "blank_nr_crt",
        F.lit("success").alias("status"))


def seq_no_profile(df: DataFrame) -> DataFrame:
    """Blank ``nr_crt`` / ``cui`` counts and the size of the ``cui -> nr_crt`` mapping."""
    has_nr = ~is_blank(F.col("nr_crt"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_blank(F.col("nr_crt"))).alias("blank_nr_crt"),
        F.count_if(is_blank(F.col("cui"))).alias("blank_cui"),
        F.count_distinct(F.when(has_nr, py_strip(F.col("cui")))).alias("mapping_size"))


def seq_no_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` mappings, in the order their first row appears in the file."""
    firsts = (df.where(~is_blank(F.col("nr_crt")))
                .groupBy(py_strip(F.col("cui")).alias("cui"))
                .agg(F.min_by("nr_crt", position(df)).alias("nr_crt"), F.min(position(df)).alias("_first")))
    return firsts.orderBy("_first").limit(n).select("cui", "nr_crt")


def lost_identifiers(raw: DataFrame, clean: DataFrame, column: str = "cui") -> DataFrame:
    """V8 (D4): identifiers present in the raw table but absent after cleaning (set
    difference, nulls equal). Both sides are reduced to distinct keys before the anti join."""
    left = raw.select(column).distinct()
    right = clean.select(F.col(column).alias("_kept")).distinct()
    return left.join(right, F.col(column).eqNullSafe(F.col("_kept")), "left_anti")


INT_MAX = 2**31 - 1


def amounts_over_int_range(loaded: DataFrame) -> DataFrame:
    """SURVEY T11: rows whose amounts would not fit the reference table's 32-bit columns
    (this engine keeps them as bigint and reports them instead of failing the load)."""
    return (loaded.where((F.col("suma_num") > INT_MAX) | (F.col("indemnizatie_variabila_num") > INT_MAX))
                  .select("id", "suma_num", "indemnizatie_variabila_num"))


# ---- the configured expectations of the warehouse (the data tests of the reference) -----
# model name -> (warehouse attribute, columns); ``top_earners`` is checked on the top list.
NOT_NULL = {
    "stg_indemnizatii_clean": ("stg", ["pk", "cui", "suma_clean", "variabila_clean"]),
    "int_indemnizatii_base": ("int_base", ["pk", "total_plata"]),
    "int_persoane_clean": ("int_persons", ["person_id"]),
    "int_companii_clean": ("int_companies", ["company_id"]),
    "fact_indemnizatii": ("fact", ["pk", "person_id", "company_id", "an_raportare"]),
    "dim_persoane": ("dim_persons", ["person_id"]),
    "dim_companii": ("dim_companies", ["company_id"]),
}
TOP_EARNERS_NOT_NULL = ["an_raportare", "person_id", "persoana", "total_salary"]
UNIQUE = [
    ("stg_indemnizatii_clean", "stg", "pk"),
    ("int_indemnizatii_base", "int_base", "pk"),
    ("int_persoane_clean", "int_persons", "person_id"),
    ("int_companii_clean", "int_companies", "company_id"),
    ("fact_indemnizatii", "fact", "pk"),
    ("dim_persoane", "dim_persons", "person_id"),
    ("dim_companii", "dim_companies", "company_id"),
]


def not_null_checks(wh) -> DataFrame:
    from salarium.operators.analytics import top_earners
    frames = [expect_not_null(getattr(wh, attr), model, cols) for model, (attr, cols) in NOT_NULL.items()]
    frames.append(expect_not_null(top_earners(wh.fact, wh.dim_persons), "top_earners", TOP_EARNERS_NOT_NULL))
    return _concat(frames)


def unique_checks(wh) -> DataFrame:
    return _concat([expect_unique(getattr(wh, attr), model, col) for model, attr, col in UNIQUE])


def relationship_checks(wh) -> DataFrame:
    return _concat([
        expect_relationship(wh.fact, "fact_indemnizatii", "person_id", wh.dim_persons, "dim_persoane", "person_id"),
        expect_relationship(wh.fact, "fact_indemnizatii", "company_id", wh.dim_companies, "dim_companii",
                            "company_id")])


def singular_checks(wh) -> DataFrame:
    from salarium.operators.analytics import top_earners
    return expect_earners_in_dim(top_earners(wh.fact, wh.dim_persons), wh.dim_persons)


def all_checks(wh) -> DataFrame:
    """Every configured expectation of the warehouse ``wh``: one row per check."""
    return _concat([not_null_checks(wh), unique_checks(wh), relationship_checks(wh), singular_checks(wh)])
