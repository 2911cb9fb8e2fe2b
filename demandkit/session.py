"""Session helpers: building a session, the shared checkpoint folder, and
size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Most bytes of values, and most rows, that we are willing to ship to every executor as a
# broadcast hash table (which takes a few times as much). Beyond either the join is a shuffle
# join; the result is the same.
BROADCAST_BYTES = 32 << 20
BROADCAST_ROW_LIMIT = 500_000


def build_session(app: str = "demandkit", cpus: int | str = "*",
                  shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the benchmark. On a cluster the caller's
    own session (spark-submit) is used instead and this is never called."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one
    (a fresh local folder) when the setting is absent and Spark runs in local
    mode, as in tests. A cluster without the setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="demandkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared checkpoint folder.

    Used only for small derived tables (daily series, encoder maps, fitted
    parameters) that are read more than once; they are bounded by the
    calendar or by a key's cardinality, never by the fact table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back. As
    :func:`materialize`, for tables that a loop makes anew from the one before: the
    size that Spark estimates for a checkpoint is that of its whole past, multiplied join
    by join, while that of a file is its own."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def row_bytes(df: DataFrame):
    """Bytes of a row's values: those of strings, binaries and arrays of them as text, eight of any other."""
    sized = [F.coalesce(F.octet_length(F.col(c).cast("string") if t.startswith(("array", "map", "struct")) else F.col(c)), F.lit(0))
             if t in ("string", "binary") or t.startswith(("array", "map", "struct")) else F.lit(8) for c, t in df.dtypes]
    return sum(sized, F.lit(16)).cast("long")


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only when a count of its rows and of their bytes proves it small.

    ``df`` should be materialized (see :func:`materialize`) so the count is
    cheap; above a limit the frame is returned unhinted and the join
    shuffles both sides instead."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df
