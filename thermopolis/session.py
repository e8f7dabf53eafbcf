"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
MIB = 1024 * 1024
GIB = 1024 * MIB
# Bounds on tasks of a stage: a shuffle keeps one status per map task and reads maps x reduces blocks.
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 50_000


def sizing(input_bytes: int, cores: int) -> dict[str, int]:
    """Split size and initial shuffle partitions for a job reading ``input_bytes``.

    128 MiB each until the task bounds are met, then larger pieces, which spill. AQE coalesces
    shuffle partitions that aggregation has made small.
    """
    split = min(GIB, max(128 * MIB, math.ceil(input_bytes / MAX_SCAN_TASKS)))
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(cores, math.ceil(input_bytes / (128 * MIB))))
    return {
        "spark.sql.files.maxPartitionBytes": split,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
    }


def build_session(
    app_name: str,
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        for key, value in sizing(input_bytes, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Days and years are UTC days and years, whatever session the caller hands in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None)
    if folder is None:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into Parquet in the shared folder and continue from the files.

    Used where one result feeds several passes (model fitting, quantiles): each reads the columns it
    needs. Unlike a cached frame it is still there after executors are lost. ``clean`` removes what
    a session's finished jobs wrote.
    """
    spark = df.sparkSession
    folder = f"{work_folder(spark)}/materialized/{spark.sparkContext.applicationId}/{uuid.uuid4()}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def clean(spark: SparkSession) -> None:
    """Remove this application's materialized tables; no frame over them may be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{work_folder(spark)}/materialized/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
