"""Text-cell expressions (P4, P5, P9, P19 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): whole-cell placeholders that become ''.
PLACEHOLDERS = ["-", "N/A", "n/a", "null", "NULL"]

# The NA tokens of the default CSV reader used when the cleaned file is read
# back for validation (the pandas defaults); each becomes ''.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Whitespace as Python's str.strip() sees it: every character below U+3001 for which
# str.isspace() holds (the highest such character is U+3000).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace as Python ``str.strip`` does (no regex: ``btrim``
    with the whitespace set is a plain codegen'd scan from both ends)."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_line_breaks(c: Column) -> Column:
    """Runs of CR/LF become one space."""
    return F.regexp_replace(c, r"[\r\n]+", " ")


def clean_cell(c: Column) -> Column:
    """Line breaks to one space, then strip."""
    return py_strip(collapse_line_breaks(c))


def blank_placeholder(c: Column) -> Column:
    """P5: exact, case-sensitive whole-cell placeholders become ''."""
    return F.when(c.isin(PLACEHOLDERS), F.lit("")).otherwise(c)


def na_token_blank(c: Column) -> Column:
    """S3: NA tokens (and nulls) become '' as in a default CSV re-read followed by fillna('')."""
    return F.when(c.isNull() | c.isin(NA_TOKENS), F.lit("")).otherwise(c)


def is_blank(c: Column) -> Column:
    """Blank after strip; null counts as blank."""
    return F.coalesce(py_strip(c) == F.lit(""), F.lit(True))


def seq_no_text(c: Column) -> Column:
    """P9, first half: drop a trailing '.0', then strip."""
    return py_strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\.0$", ""))


def normalize_seq_no_cell(c: Column) -> Column:
    """Drop a trailing '.0', strip, and the texts 'nan'/'None' become ''."""
    v = seq_no_text(c)
    return F.when(v.isin("nan", "None"), F.lit("")).otherwise(v)
