"""Helpers shared by the operators: words, shared scratch tables, spread lookups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words: space and \x09-\x0D.
BREAKS = " \t\n\x0b\f\r"
BREAK_RUN = r"[ \t-\r]+"


def words(text: Column) -> Column:
    """Array of the maximal runs of non-break characters; null and blank texts give []."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BREAK_RUN))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share (``spark.checkpoint.dir``).

    Where it is unset, a temporary one is made for a ``local[...]`` master
    only; on a cluster the missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlake-llm-"))
    return sc.getCheckpointDir().rstrip("/")


#: Rows of a narrow table that one task writes where their number is known.
ROWS_A_TASK = 50_000


class Scratch:
    """Tables in the shared folder. Writing one cuts the lineage: a lost
    executor costs only the tasks that read it, never the steps before it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/cohortlake-{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write and read again. ``rows``, if the number of rows is known not to be
        greater, lets a small table be written by few tasks, ``ROWS_A_TASK`` each."""
        if rows is not None:
            df = df.coalesce(1 + rows // ROWS_A_TASK)
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)

    def keep_only(self, *names: str) -> None:
        """Delete all tables but these."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        if fs.exists(root):
            self.drop(*({s.getPath().getName() for s in fs.listStatus(root)} - {*names}))


#: Rows of a narrow table (tens of bytes each) up to which it is sent to every executor.
BROADCAST_ROWS = 400_000


def sized(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (a written one, so that counting reads footers only) marked for
    broadcast if it has at most ``limit`` rows; a larger one joins through the shuffle."""
    return F.broadcast(table) if table.count() <= limit else table


#: Ways that rows with one key are spread over when they look up a fact.
WAYS = 32


def spread_lookup(detail: DataFrame, facts: DataFrame, on: str, by: Column, ways: int = WAYS, how: str = "left") -> DataFrame:
    """Join detail rows to ``facts`` (one row per key) with every key split
    ``ways`` ways, so that a key with a third of all rows is no single task's.

    The detail row's share is a pure function of ``by``; facts are repeated once
    per share. Keep ``facts`` to the keys that several rows have; it is a written
    table, and at most ``BROADCAST_ROWS`` facts are broadcast instead.
    """
    if facts.count() <= BROADCAST_ROWS:
        return detail.join(F.broadcast(facts), on, how)
    share = "__share"
    d = detail.withColumn(share, F.pmod(F.xxhash64(by), F.lit(ways)).cast("int"))
    f = facts.withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return d.join(f, [on, share], how).drop(share)
