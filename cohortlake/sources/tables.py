"""Table scans. Parquet keeps the scans columnar: Catalyst prunes columns and
pushes the ``voided = 0`` and date filters into the reader."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortlake.sources import versioned
from cohortlake.sources.schemas import conform


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (a file, a folder of part files or a folder of versions)."""
    return versioned.read(spark, f"{base.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: read_table(spark, base, n) for n in names}


class TableSet:
    """Clinical tables stored as ``<base>/<name>.parquet``, exposed as attributes
    (the same interface as the fixture adapter). A table is listed and its
    footers are read once, when it is first used, and it is held against the registry of
    base tables (``sources.schemas``): missing columns are an error, other types are cast.
    With ``schemas`` (table name -> schema) the footers of those tables are not read, and a file
    of other types fails the scan."""

    def __init__(self, spark: SparkSession, base: str, schemas: Mapping[str, StructType] | None = None):
        self.spark = spark
        self.base = base
        self.schemas = schemas or {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self.schemas:
            path = f"{self.base.rstrip('/')}/{name}.parquet"
            table = self.spark.read.schema(self.schemas[name]).parquet(versioned.current(self.spark, path) or path)
        else:
            table = conform(read_table(self.spark, self.base, name), name)
        setattr(self, name, table)  # later uses find the attribute itself
        return table


class CatalogTables:
    """Clinical tables registered in the session catalog (``<database>.<name>``)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark = spark
        self.database = database

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return conform(self.spark.table(f"{self.database}.{name}" if self.database else name), name)


class JdbcTables:
    """Clinical tables read over JDBC, each split into parallel range reads on
    a numeric column (``partition_column``) so no single task reads a whole
    table. ``bounds`` maps table -> (lower, upper) of that column; a table that
    has none is an error unless ``single_task`` names it as small enough for one.
    """

    def __init__(self, spark: SparkSession, url: str, properties: dict, partition_column: str = "patient_pk",
                 bounds: dict[str, tuple[int, int]] | None = None, num_partitions: int = 200,
                 table_names: dict[str, str] | None = None, single_task: Iterable[str] = ()):
        self.spark = spark
        self.url = url
        self.properties = dict(properties)
        self.partition_column = partition_column
        self.bounds = bounds or {}
        self.num_partitions = num_partitions
        self.table_names = table_names or {}
        self.single_task = frozenset(single_task)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.table_names.get(name, name)
        if name in self.bounds:
            lo, hi = self.bounds[name]
            return conform(self.spark.read.jdbc(self.url, table, column=self.partition_column, lowerBound=lo,
                                                upperBound=hi, numPartitions=self.num_partitions,
                                                properties=self.properties), name)
        if name not in self.single_task:
            raise ValueError(f"{name} has no bounds on {self.partition_column}; give them, or name it in single_task")
        return conform(self.spark.read.jdbc(self.url, table, properties=self.properties), name)
