"""Warehouse models P11-P15, J1-J2, F3: staging, intermediate, fact and dimensions.

Semantics kept from the reference (SURVEY T1): DISTINCT is taken on raw names *before*
normalisation, so one ``person_id`` / ``company_id`` can have several rows and the fact's
left joins multiply rows. ``dedupe=True`` gives the one-row-per-id variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salarium.plans.joins import bounded, hinted

DEFAULT_YEAR = 2025

# Column names of the loaded and the staging table.
STAGING_RENAMES = {
    "id": "pk",
    "personal": "nume",
    "calitate_membru": "functie",
    "suma": "suma_raw",
    "indemnizatie_variabila": "variabila_raw",
    "suma_num": "suma_clean",
    "indemnizatie_variabila_num": "variabila_clean",
}
STAGING_COLUMNS = [
    "pk", "nr_crt", "autoritate_tutelara", "intreprindere", "cui", "nume", "functie",
    "suma_raw", "variabila_raw", "suma_clean", "variabila_clean",
]


def staging(loaded: DataFrame) -> DataFrame:
    """Pure rename/projection of the loaded table."""
    cols = [F.col(c).alias(STAGING_RENAMES.get(c, c)) for c in loaded.columns]
    out = loaded.select(*cols)
    keep = [c for c in STAGING_COLUMNS + ["created_at"] if c in out.columns]
    return out.select(*keep)


def base(stg: DataFrame) -> DataFrame:
    """Amounts coalesced to 0 and ``total_plata`` = their sum."""
    s = F.coalesce(F.col("suma_clean"), F.lit(0))
    v = F.coalesce(F.col("variabila_clean"), F.lit(0))
    return stg.select(
        "pk", "nr_crt", "autoritate_tutelara", "intreprindere", "cui", "nume", "functie",
        s.alias("suma_clean"), v.alias("variabila_clean"), (s + v).alias("total_plata"))


def _norm(c):
    return F.trim(F.upper(c))


def persons(stg: DataFrame) -> DataFrame:
    """P13 + D1: distinct raw names, then ``person_id = md5(trim(upper(name)))``."""
    names = stg.select("nume").distinct()
    return names.select(F.md5(_norm(F.col("nume"))).alias("person_id"),
                        _norm(F.col("nume")).alias("nume_normalizat"))


def companies(stg: DataFrame) -> DataFrame:
    """P14 + D2: distinct (cui, name), then ``company_id = cui``, name normalised."""
    pairs = stg.select("cui", "intreprindere").distinct()
    return pairs.select(F.col("cui").alias("company_id"),
                        _norm(F.col("intreprindere")).alias("nume_companie"))


def dim_persons(int_persons: DataFrame) -> DataFrame:
    """dimension rows with a key."""
    return int_persons.where(F.col("person_id").isNotNull()).select("person_id", "nume_normalizat")


def dim_companies(int_companies: DataFrame) -> DataFrame:
    """dimension rows with a key; the name column is ``denumire``."""
    return (int_companies.where(F.col("company_id").isNotNull())
                         .select("company_id", F.col("nume_companie").alias("denumire")))


def fact(int_base: DataFrame, int_persons: DataFrame, int_companies: DataFrame,
         year: int = DEFAULT_YEAR, dedupe: bool = False) -> DataFrame:
    """J1 + J2 + P15: one row per (base row x matching person rows x matching company rows).

    ``dedupe=True`` joins against one row per id instead (no fan-out).
    """
    p = int_persons.select(F.col("person_id"), _norm(F.col("nume_normalizat")).alias("_p_key"))
    c = int_companies.select(F.col("company_id").alias("_c_key"), F.col("company_id"))
    if dedupe:
        p = p.dropDuplicates(["_p_key"])
        c = c.dropDuplicates(["_c_key"])
    b = int_base.select("pk", "nume", "cui", "total_plata", "suma_clean", "variabila_clean")
    b = b.withColumn("_b_p_key", _norm(F.col("nume")))
    j = _left_lookup(b, "_b_p_key", p, "_p_key")
    j = _left_lookup(j, "cui", c, "_c_key")
    return j.select(
        "pk", "person_id", "company_id", "total_plata", "suma_clean", "variabila_clean",
        F.lit(year).cast("int").alias("an_raportare"))


def _left_lookup(rows: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """Left join of ``rows`` with a lookup keyed by ``lookup_key`` (duplicates multiply rows).

    Rows whose key is null can never match, so they bypass the join (they would all hash to
    one reducer). The lookup is written once and gets a broadcast hint when it fits the size
    bound; without the hint AQE splits hot keys of the sort-merge join. Either way the plan
    above and the rows are the same.
    """
    written, fits = bounded(lookup)
    table = hinted(written, fits)
    extra = [c for c in table.columns if c != lookup_key]
    matched = rows.where(F.col(key).isNotNull()).join(table, F.col(key) == F.col(lookup_key), "left")
    unmatched = rows.where(F.col(key).isNull()).select(
        "*", *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in extra])
    return matched.drop(lookup_key).unionByName(unmatched)
