"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (T15), ANSI casts (a bad value
# fails the job as in the reference database), adaptive execution for runtime
# re-planning of joins, partition coalescing and skewed-join splitting.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "listingmart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the job settings applied.

    On a cluster, ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Checkpoint files of frames no longer referenced are removed (core setting: builder only).
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        configured = tempfile.mkdtemp(prefix="listingmart-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_by(df: DataFrame, col: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder, a folder for each value of ``col``, and read it back.

    For frames that are read more than once, by ``col`` or in part: columns and folders are pruned.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stored/{uuid.uuid4().hex}"
    df.write.partitionBy(col).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def default_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
