"""The raw tables on disk: users, products, product views, orders and their items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schemas
from tidemark.sources.adapters import Commerce
from tidemark.sources.tables import CommitLog, nullable

TABLES = {
    "users": schemas.USERS,
    "products": schemas.PRODUCTS,
    "product_views": schemas.PRODUCT_VIEWS,
    "orders": schemas.ORDERS,
    "order_items": schemas.ORDER_ITEMS,
}
# Event tables are partitioned by day, so a window of time reads only its own days.
DAY_COLUMNS = {"product_views": ("view_date", "view_ts"), "orders": ("order_date", "order_ts")}

_LOADS = T.StructType(
    [
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
        # The loads that make up a table, where it is not this one alone
        T.StructField("parts", T.MapType(T.StringType(), T.ArrayType(T.LongType()))),
    ]
)


class RawTables:
    """Tables by load. A full load replaces all tables, an added one brings more rows of some.

    Each writes a new folder and then becomes the current one; an added load names the folders
    that it goes on from, so what it brought can be read apart from the rest.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/raw"
        self.loads = CommitLog(spark, f"{self.root}/loads", _LOADS)

    def replace_tables(self, frames: Mapping[str, DataFrame]) -> dict[str, int]:
        """Replace the contents of all raw tables; returns the rows written per table."""
        version = self.loads.next_version()
        counts = {table: self._write(table, version, frame) for table, frame in frames.items()}
        self.loads.commit(version, counts=counts, parts={table: [version] for table in counts})
        return counts

    def add_rows(self, frames: Mapping[str, DataFrame]) -> int:
        """Add new rows to some of the tables; returns the number of the load.

        Rows may be of any day. They are not compared with those that are there.
        """
        current = self._current()
        version = current["version"] + 1
        counts = {table: self._write(table, version, frame) for table, frame in frames.items()}
        parts = dict(self._parts(current))
        for table in counts:
            parts[table] = [*parts.get(table, []), version]
        totals = {**current["counts"]}
        for table, count in counts.items():
            totals[table] = totals.get(table, 0) + count
        self.loads.commit(version, counts=totals, parts=parts)
        return version

    def added(self, version: int) -> dict[str, DataFrame]:
        """The rows that one load brought."""
        found = self.loads.last(F.col("version") == version)
        if found is None:
            raise LookupError(f"no load {version}")
        own = [table for table, parts in self._parts(found).items() if version in parts]
        return {table: self._read(table, [version]) for table in own}

    def read(self) -> Commerce:
        """The tables as of the current load."""
        parts = self._parts(self._current())
        return Commerce(**{table: self._read(table, parts[table]) for table in TABLES if table in parts})

    def _current(self) -> dict:
        current = self.loads.last()
        if current is None:
            raise LookupError(f"no raw tables were loaded to {self.root}")
        return current

    @staticmethod
    def _parts(load: dict) -> dict[str, list[int]]:
        return load["parts"] or {table: [load["version"]] for table in load["counts"]}

    def _write(self, table: str, version: int, frame: DataFrame) -> int:
        typed = frame.select(
            *[F.col(field.name).cast(field.dataType) for field in TABLES[table].fields]
        )
        path = f"{self.root}/v={version}/{table}"
        if table in DAY_COLUMNS:
            day, ts = DAY_COLUMNS[table]
            # Rebalancing gives each day few files and splits days that are too large
            typed = typed.withColumn(day, F.to_date(ts)).hint("rebalance", F.col(day))
            typed.write.mode("overwrite").partitionBy(day).parquet(path)
        else:
            typed.write.mode("overwrite").parquet(path)
        # Counting a written table reads only the Parquet footers
        return self._read(table, [version]).count()

    def _read(self, table: str, versions: Sequence[int]) -> DataFrame:
        schema = nullable(TABLES[table])
        if table in DAY_COLUMNS:
            schema.add(DAY_COLUMNS[table][0], T.DateType())
        paths = [f"{self.root}/v={version}/{table}" for version in versions]
        frames = [self.spark.read.schema(schema).parquet(path) for path in paths]
        return reduce(DataFrame.unionByName, frames)
