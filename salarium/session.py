"""Session settings and the one materialisation primitive used across the engine."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on: AQE for runtime join selection, partition coalescing and
# skew splitting; UTC so load timestamps do not depend on the host. HotSpot leaves methods of
# over 8,000 bytes interpreted, and the cleaning, scoring and raw-table projections generate such
# ones: beyond that size Spark runs a stage operator by operator, in methods that are compiled.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "salarium",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # checkpoint files of unreferenced RDDs are removed by the context cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Switch on AQE, skew handling and the method limit for sessions created elsewhere (e.g. by a driver)."""
    for k, v in SESSION_DEFAULTS.items():
        if k != "spark.sql.session.timeZone" and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir``); only a local-mode session without one
    (tests, the bench) gets a fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote client: the server side owns the context and its settings
        return spark.conf.get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster[...] is a cluster, too
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="salarium-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and cut its lineage.

    Used where a result is read by several consumers (the marts, the typed load) or where
    values computed by non-deterministic expressions (partition ids) must stay fixed across
    re-execution after an executor loss. Never a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    For tables read by many queries (the marts): unlike a checkpoint, a Parquet table gives
    later plans column pruning, filter pushdown and real sizes for join planning. Partition
    order is not preserved, so order-dependent steps use ``materialize`` instead.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
