"""What the engine needs from a Spark session."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set at run time on whatever session the caller brings; all of them are safe to repeat.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# What one shuffle partition should hold at most, so that it sorts in an executor's memory.
PARTITION_BYTES = 256 * 1024**2


def prepare(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Apply the engine's settings to a session and return it.

    `shuffled_bytes`, the size of the largest table that is shuffled, raises the number of shuffle
    partitions to fit it. Adaptive execution joins partitions that turn out small, so a number that
    is too large costs little; one that is too small spills.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if shuffled_bytes is not None:
        needed = math.ceil(shuffled_bytes / PARTITION_BYTES)
        if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and written work tables.

    A cluster names it in `spark.checkpoint.dir`. Only a local session without one gets a
    temporary folder; on a cluster a folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def spread_by(frame: DataFrame, key: str) -> DataFrame:
    """Deal the rows out by a key before each becomes many.

    The number of partitions is given, so adaptive execution does not join partitions that are
    small only until then.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(partitions, key)


def discard(*frames: DataFrame) -> None:
    """Empty the work tables of frames that `cut` returned and nothing reads any more.

    The folder stays, with an empty table, as Spark's writers only replace what is in it.
    """
    for frame in frames:
        folder = {file.rpartition("/")[0] for file in frame.inputFiles()}
        for path in folder:
            if "/cut-" in path:
                frame.sparkSession.createDataFrame([], "none int").write.mode("overwrite").parquet(path)


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to a new table in the shared folder and go on from there.

    The lineage is short again and survives lost executors. A Parquet table is read by column and
    counted from its footers, which a checkpointed RDD is not.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
