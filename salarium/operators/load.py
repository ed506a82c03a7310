"""Typed load S7-S9: the clean table as the warehouse's raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salarium.operators.cleaning import position_cols
from salarium.functions.amounts import cast_or_fail
from salarium.plans.sequence import TAGS, number_tagged, with_sequence

# Column order of the bulk load (fixed by the load statement of the reference).
LOAD_COLUMNS = [
    "nr_crt", "autoritate_tutelara", "intreprindere", "cui", "personal", "calitate_membru",
    "suma", "indemnizatie_variabila", "suma_num", "indemnizatie_variabila_num",
]
INT_COLUMNS = {"nr_crt": "int", "suma_num": "bigint", "indemnizatie_variabila_num": "bigint"}


def as_loaded(clean: DataFrame, with_timestamp: bool = False, counted: DataFrame | None = None,
              loaded_at: Column | None = None) -> DataFrame:
    """S7 + S8 (+ S9): bulk-load typing of the clean table.

    * '' -> NULL in every column (an unquoted empty CSV field loads as NULL);
    * ``nr_crt`` to int and the amounts to bigint with ANSI casts, so a non-numeric value
      fails the load, as the bulk load does;
    * ``id`` = 1..n in file order (``src_file``, ``src_row``), assigned without a
      single-partition window;
    * optional ``created_at``: one timestamp per load (``loaded_at``, else the time of the run),
      carried into staging.

    When ``clean`` carries the order tags of ``plans.sequence`` (it was range-sorted on
    ``src_row`` and written with them), the ids come from those tags without another sort.
    """
    tagged = all(t in clean.columns for t in TAGS)
    order = position_cols(clean)
    typed = clean.select(
        *order, *(TAGS if tagged else []),
        *[(cast_or_fail(F.nullif(F.col(c).cast("string"), F.lit("")), INT_COLUMNS[c]) if c in INT_COLUMNS
           else F.nullif(F.col(c), F.lit(""))).alias(c) for c in LOAD_COLUMNS])
    numbered = number_tagged(typed, "id", counted=counted) if tagged else with_sequence(typed, order, "id")
    loaded = numbered.select("id", *LOAD_COLUMNS)
    if with_timestamp or loaded_at is not None:
        loaded = loaded.withColumn("created_at", F.current_timestamp() if loaded_at is None else loaded_at)
    return loaded
