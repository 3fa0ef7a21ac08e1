"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A table of one narrow key column below this many rows takes well under 100 MB
# as a hash relation, which fits any executor that can run the job at all.
BROADCAST_ROWS = 1_000_000


def local_session(cpus: int | str = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # Split a hot key even where the next step groups by the join's key.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or what
    ``SparkContext.setCheckpointDir`` was given.

    Only a local session that names neither falls back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return os.path.join(tempfile.gettempdir(), "tidemark-shared")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Measure whether ``df`` has at most ``rows`` rows.

    A plain count: partial counts are summed, where a limit would first send that
    many rows of every partition to one task.
    """
    return df.count() <= rows
