"""End-to-end composition: raw -> clean -> loaded -> staging -> intermediate -> marts.

Materialisation follows the reference's model config: staging and intermediate models are
views (lazy plans here); the loaded table and the marts (fact, dimensions) are tables,
written once as Parquet under the checkpoint folder and then shared by every query. The
fact is read by six models and the anomaly review, so writing it once avoids recomputing
the cleaning, load and both fan-out joins per query. The prepared table (rows sorted on
file position, cleaned, tagged for the id assignment) is the one other full write.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salarium.functions.text import na_token_blank
from salarium.operators import anomaly, audit, cleaning, load, models
from salarium.plans.sequence import TAGS, add_tags, sort_and_tag
from salarium.session import apply_defaults, write_table
from salarium.sources import fixture


class Warehouse:
    """Lazily built stages over one raw table; marts are materialised on first use."""

    def __init__(self, raw: DataFrame, year: int = models.DEFAULT_YEAR, materialize_marts: bool = True,
                 loaded_at: Column | None = None):
        self.raw = raw
        self.loaded_at = loaded_at  # the load's timestamp, or none (the registered queries)
        self.year = year
        self._materialize = materialize_marts
        self._runs: dict[tuple, object] = {}

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, name) if self._materialize else df

    @cached_property
    def _prepared_tagged(self) -> DataFrame:
        """Raw rows range-partitioned and sorted on ``src_row`` (the sampling and shuffle
        passes read the cheap raw columns), then the row-local cleaning once as a narrow
        step, tagged with partition id and position, written once (Parquet)."""
        ordered = sort_and_tag(self.raw, cleaning.position_cols(self.raw))
        return write_table(add_tags(cleaning.prepare(ordered)), "prepared")

    @cached_property
    def before_inference(self) -> DataFrame:
        """The table as the identifier inference sees it (after P9, before P10)."""
        return self._prepared_tagged.drop(*TAGS)

    @cached_property
    def _clean_tagged(self) -> DataFrame:
        return cleaning.infer_seq_no(self._prepared_tagged)

    @cached_property
    def clean(self) -> DataFrame:
        """The cleaned table (P10 applied)."""
        return self._clean_tagged.drop(*TAGS)

    @cached_property
    def clean_reread(self) -> DataFrame:
        """The clean table as validation reads it back from CSV: all text, NA tokens -> ''."""
        pos = cleaning.position_cols(self.clean)
        data = [c for c in self.clean.columns if c not in cleaning.BOOKKEEPING]
        return self.clean.select(*pos, *[na_token_blank(F.col(c).cast("string")).alias(c) for c in data])

    @cached_property
    def loaded(self) -> DataFrame:
        # the loaded table of the warehouse: typed rows with ids from the order tags, written
        # once; the inference join keeps every prepared row once, so the per-partition counts
        # come from the prepared table's tag columns
        loaded = load.as_loaded(self._clean_tagged, counted=self._prepared_tagged, loaded_at=self.loaded_at)
        return self._table(loaded, "indemnizatii_clean")

    @cached_property
    def stg(self) -> DataFrame:
        return models.staging(self.loaded)

    @cached_property
    def int_base(self) -> DataFrame:
        return models.base(self.stg)

    @cached_property
    def int_persons(self) -> DataFrame:
        # read by the fact's lookup and by the dimension: one distinct pass, written once
        return self._table(models.persons(self.stg), "int_persoane_clean")

    @cached_property
    def int_companies(self) -> DataFrame:
        return self._table(models.companies(self.stg), "int_companii_clean")

    @cached_property
    def fact(self) -> DataFrame:
        return self._table(models.fact(self.int_base, self.int_persons, self.int_companies, self.year),
                           "fact_indemnizatii")

    @cached_property
    def fact_deduped(self) -> DataFrame:
        return models.fact(self.int_base, self.int_persons, self.int_companies, self.year, dedupe=True)

    @cached_property
    def dim_persons(self) -> DataFrame:
        return self._table(models.dim_persons(self.int_persons), "dim_persoane")

    @cached_property
    def dim_companies(self) -> DataFrame:
        return self._table(models.dim_companies(self.int_companies), "dim_companii")

    # ---- anomaly review run (the reference stores these in its audit tables) ----------

    def review_slice(self, year: int | None = None, limit: int | None = None) -> DataFrame:
        return anomaly.fact_slice(self.fact, year, limit)

    def slice_stats(self, year: int | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame, bool]:
        """Peer statistics of one review slice, written once and shared by its queries."""
        key = ("stats", year, limit)
        if key not in self._runs:
            self._runs[key] = anomaly.peer_statistics(self.review_slice(year, limit))
        return self._runs[key]

    def scores(self, year: int | None = None, limit: int | None = None) -> DataFrame:
        return anomaly.anomaly_scores(self.review_slice(year, limit), self.slice_stats(year, limit))

    def flagged(self, year: int | None = None, limit: int | None = None, min_score: float = 3.0) -> DataFrame:
        key = ("flagged", year, limit, min_score)
        if key not in self._runs:
            queue = anomaly.review_queue(self.fact, year, limit, min_score, self.slice_stats(year, limit))
            self._runs[key] = self._table(queue, "flagged")
        return self._runs[key]

    def candidates(self, run_id: str, source_table: str, year: int | None = None, limit: int | None = None,
                   min_score: float = 3.0) -> DataFrame:
        key = ("candidates", run_id, source_table, year, limit, min_score)
        if key not in self._runs:
            self._runs[key] = audit.candidates(self.flagged(year, limit, min_score), run_id, source_table)
        return self._runs[key]


_CACHE: dict[tuple, Warehouse] = {}
_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, year: int = models.DEFAULT_YEAR) -> Warehouse:
    """One warehouse per (application, input folder, year), like one dbt build per run."""
    apply_defaults(spark)
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # a session without a local SparkContext (remote client)
        app = id(spark)
    key = (app, sf_dir.rstrip("/"), year)
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = Warehouse(fixture.raw_table(spark, sf_dir), year=year)
            _CACHE[key] = wh
        return wh
