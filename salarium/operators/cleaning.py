"""Cleaning operators P1-P10 (raw file table -> clean table).

All per-row work is one projection of native expressions; the only shuffle is the small
aggregation behind ``infer_seq_no``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salarium.functions.amounts import clean_amount_stages, digits_to_int_stages, split_base_variable_stages
from salarium.functions.text import blank_placeholder, clean_cell, is_blank, seq_no_text
from salarium.plans.joins import bounded, hinted

# Normalised source headers -> short column names.
SOURCE_RENAMES = {
    "nr.crt": "nr_crt",
    "autoritate_public_tutelar_(apt)": "autoritate_tutelara",
    "nume_ntreprindere_public": "intreprindere",
    "cui": "cui",
    "nume_personal_conducere": "personal",
    "calitate_(membru_ca/cs_director/membru_directorat)": "calitate_membru",
    "valoare_indemnizaie_fix_lunar_conform_contract_(brut-lei)*": "suma",
    "valoare_indemnizaie_variabila_anual_conform_contract_(brut-lei)*": "indemnizatie_variabila",
}

AMOUNT_COLUMNS = ["suma", "indemnizatie_variabila"]
# A row's place in the input: the file it came from (when read from files), then its
# position inside that file. Together they give "file order".
POSITION = ["src_file", "src_row"]
BOOKKEEPING = {"src_file", "src_row", "_bad"}


def position_cols(df: DataFrame) -> list[str]:
    """The position columns ``df`` carries, most significant first."""
    return [c for c in POSITION if c in df.columns]


def position(df: DataFrame):
    """One orderable value for a row's place in the input (for ``min_by`` / ``min``)."""
    cols = position_cols(df)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def normalize_column_name(name: str) -> str:
    """The lower-case ASCII words of a header cell (separated by blanks, line ends or
    underscores), joined by one underscore each."""
    words = re.split(r"[ \r\n_]+", "".join(ch for ch in name if ch.isascii()))
    return "_".join(w.lower() for w in words if w)


def normalize_columns(df: DataFrame) -> DataFrame:
    """P1 on the header only (driver-side work on column names, never on rows)."""
    return df.toDF(*[c if c in BOOKKEEPING else normalize_column_name(c) for c in df.columns])


def rename_source(df: DataFrame) -> DataFrame:
    """Fixed header map; unknown columns pass through."""
    return df.toDF(*[SOURCE_RENAMES.get(c, c) for c in df.columns])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose every data column is null (cells are '' after reading, so rows of
    blanks survive, as in the reference)."""
    data_cols = [c for c in df.columns if c not in BOOKKEEPING]
    return df.na.drop("all", subset=data_cols)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in BOOKKEEPING and f.dataType.simpleString() == "string"]


def clean_text(df: DataFrame) -> DataFrame:
    """Every text column: CR/LF runs -> one space, then strip."""
    cols = set(_text_columns(df))
    return df.select(*[clean_cell(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def blank_placeholders(df: DataFrame) -> DataFrame:
    """P5: whole-cell placeholders -> '' in every text column."""
    cols = set(_text_columns(df))
    return df.select(*[blank_placeholder(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def split_base_variable(df: DataFrame) -> DataFrame:
    """P6: 'base - variable' in ``suma`` moves its right side to ``indemnizatie_variabila``."""
    if "suma" not in df.columns:
        return df
    if "indemnizatie_variabila" not in df.columns:
        df = df.withColumn("indemnizatie_variabila", F.lit(None).cast("string"))
    return split_base_variable_stages(df, "suma", "indemnizatie_variabila")


def clean_amounts(df: DataFrame) -> DataFrame:
    """P7 on both amount columns."""
    return clean_amount_stages(df, [c for c in AMOUNT_COLUMNS if c in df.columns])


def amounts_numeric(df: DataFrame) -> DataFrame:
    """``suma_num`` and ``indemnizatie_variabila_num`` (digits only, '' -> 0)."""
    pairs = {"suma": "suma_num"}
    if "indemnizatie_variabila" in df.columns:
        pairs["indemnizatie_variabila"] = "indemnizatie_variabila_num"
    return digits_to_int_stages(df, pairs)


def normalize_seq_no(df: DataFrame) -> DataFrame:
    """``nr_crt`` without '.0', stripped, 'nan'/'None' -> ''."""
    if "nr_crt" not in df.columns:
        return df
    df = df.withColumn("_p9_nr", seq_no_text(F.col("nr_crt")))
    v = F.col("_p9_nr")
    return df.withColumn("nr_crt", F.when(v.isin("nan", "None"), F.lit("")).otherwise(v)).drop("_p9_nr")


def seq_no_mapping(df: DataFrame) -> DataFrame:
    """``cui -> nr_crt`` of the first row (file order) with a non-blank ``nr_crt``.

    ``min_by`` is a partial aggregate: a company holding a third of all rows is reduced
    map-side before the shuffle, so no task sees its rows.
    """
    return (df.where(~is_blank(F.col("nr_crt")))
              .groupBy("cui")
              .agg(F.min_by("nr_crt", position(df)).alias("_mapped_nr_crt")))


def infer_seq_no(df: DataFrame) -> DataFrame:
    """P10: blank ``nr_crt`` filled from the first non-blank row with the same ``cui``.

    No match -> ''. A blank ``cui`` is a key like any other. Skipped when a column is missing.
    The mapping (one row per ``cui``) is broadcast when it fits the size bound, so the table
    is not shuffled; beyond it the join shuffles on ``cui`` and AQE splits a hot ``cui``.
    """
    if "nr_crt" not in df.columns or "cui" not in df.columns:
        return df
    mapping, fits = bounded(seq_no_mapping(df))
    right = hinted(mapping.select(F.col("cui").alias("_lk_cui"), "_mapped_nr_crt"), fits)
    joined = df.join(right, df["cui"].eqNullSafe(right["_lk_cui"]), "left")
    filled = F.when(is_blank(F.col("nr_crt")), F.coalesce(F.col("_mapped_nr_crt"), F.lit(""))).otherwise(F.col("nr_crt"))
    return joined.withColumn("nr_crt", filled).select(*df.columns)


STEPS = [
    ("drop_empty", drop_empty_rows),
    ("text", clean_text),
    ("placeholders", blank_placeholders),
    ("split", split_base_variable),
    ("amounts", clean_amounts),
    ("numeric", amounts_numeric),
    ("seq_no", normalize_seq_no),
]


def prepare(raw: DataFrame, upto: str = "seq_no") -> DataFrame:
    """Row-local cleaning P3-P9 in the reference's order, up to and including step ``upto``
    (one projection chain, no shuffle)."""
    df = raw
    for name, step in STEPS:
        df = step(df)
        if name == upto:
            return df
    raise ValueError(f"unknown cleaning step {upto!r}")


def clean(raw: DataFrame) -> DataFrame:
    """The whole cleaning stage: P3-P9, then the identifier inference P10.
    (P1/P2 apply to file sources, see ``sources.files``.)"""
    return infer_seq_no(prepare(raw))
