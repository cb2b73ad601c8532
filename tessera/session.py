"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ANSI mode stays on (Spark 4 default); the session zone is UTC so that
    TIMESTAMP and DATE arithmetic matches the DuckDB oracle.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Spill-aware sizing: scans split at 128 MiB and AQE coalesces
        # shuffle output towards 128 MiB partitions, so the static partition
        # count is only an upper bound at any scale.
        .config("spark.sql.files.maxPartitionBytes", str(128 << 20))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Settings every query needs, applied to a session we did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir`` (or
    in the context's checkpoint folder).

    Without one, a local session (one JVM: tests, this machine) gets a scratch
    folder; on a cluster that would be one machine's disk, so it is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df, name: str = "cut"):
    """Materialise a small, reused intermediate as a parquet table in the
    shared checkpoint folder and read it back, so later branches read it
    instead of recomputing it, and a lost executor does not force a
    recompute from the sources (never ``localCheckpoint``; a written table
    also avoids the second computation an unpersisted RDD checkpoint makes)."""
    import uuid
    path = scratch_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
