"""salarium — Spark-native engine for messy public pay disclosures.

Layers (each a set of ``DataFrame -> DataFrame`` or ``Column -> Column`` functions):

* ``functions``  column expressions for text and amount cleaning (no Python UDFs)
* ``sources``    file readers/writers and the adapter that derives the raw table from the driver tables
* ``operators``  cleaning, typed load, warehouse models, analytics, quality checks, anomaly scoring, audit
* ``plans``      distributed building blocks (row ids, exact percentiles, size-checked broadcast,
                 materialisation) and the end-to-end warehouse composition
* ``streaming``  intentionally empty: the workload is full-reload batch
"""

from salarium.session import build_session, checkpoint_dir, materialize

__all__ = ["build_session", "checkpoint_dir", "materialize"]
