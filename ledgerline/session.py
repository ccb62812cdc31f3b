"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session with AQE on, UI off and UTC time (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, executor_memory_bytes: int = 8 << 30, cores_per_executor: int = 4,
                   executors: int = 1000) -> dict[str, str]:
    """SQL settings sized for an input of ``input_bytes``.

    Shuffle partitions target ~256 MiB each (AQE coalesces smaller ones and
    splits skewed ones), never fewer than the cluster's task slots, and a
    task's share of executor memory must hold a partition with headroom for
    sort/aggregate buffers (spill covers the rest). Scan splits are 256 MiB.
    """
    slots = max(1, cores_per_executor * executors)
    per_task = executor_memory_bytes // max(1, cores_per_executor)
    target = min(256 << 20, max(32 << 20, per_task // 4))
    partitions = max(slots, -(-input_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, **cluster) -> dict[str, str]:
    """Set ``scale_settings`` on the session (all are runtime SQL settings)."""
    conf = scale_settings(input_bytes, **cluster)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    and is never overridden. Only when it is unset (local tests) a scratch
    folder is created.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder, for a frame that several later steps read:
    it is computed once, and its readers scan only the columns they need."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"written-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that yields fewer splits than there are cores.

    A single-row-group file is one task; CPU-heavy projections after it
    would run on one core. At cluster scale scans already have many splits
    and this is a no-op (no extra shuffle).
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
