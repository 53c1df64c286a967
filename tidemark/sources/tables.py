"""Small helpers shared by every table on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at the path, on whatever file system it names."""
    try:
        spark.read.schema("exists int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at `path`, or no rows when nothing was ever written there."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class CommitLog:
    """An append-only table of versions: a row is added only after its data is fully written.

    Readers take the greatest version, so a replaced data set switches at once and a writer that
    dies half-way leaves the previous version in place. One row per commit, so it stays small.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = T.StructType([T.StructField("version", T.LongType()), *schema.fields])

    def rows(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)

    def last(self, condition=None) -> dict | None:
        """The newest committed row (that meets the condition)."""
        rows = self.rows() if condition is None else self.rows().where(condition)
        found = rows.orderBy(F.col("version").desc()).limit(1).collect()
        return found[0].asDict(recursive=True) if found else None

    def next_version(self) -> int:
        last = self.last()
        return 1 if last is None else last["version"] + 1

    def commit(self, version: int, **fields) -> None:
        self.commit_all(version, [fields])

    def commit_all(self, version: int, entries: Sequence[dict]) -> None:
        """Several rows of one version, in one file and so all at once."""
        rows = [
            tuple({"version": version, **entry}[name] for name in self.schema.names)
            for entry in entries
        ]
        frame = self.spark.createDataFrame(rows, self.schema)
        frame.coalesce(1).write.mode("append").parquet(self.path)
