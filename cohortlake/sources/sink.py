"""Full-refresh sink: write to a staging place, then swap it in.

The source system dropped the table before re-creating it, so readers saw a
gap and a failed build left no table. Here the new data is written completely
(task retries and lost executors only redo their own files) and then swapped
for the old table with two checked renames; if the second fails, the old table
is put back, and it is deleted only when the new one stands. Between the two
renames the name is absent for a moment; readers that cannot bear that read
a view (``overwrite_catalog_table`` with ``view=True``) or a folder of versions (``versioned``).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _rename(fs, source, target) -> None:
    """Rename that raises where the file system only returns false."""
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def _swap(exists: bool, set_aside, put_in, put_back, discard) -> None:
    """Set the old table aside, put the new one in; on failure put the old one back."""
    if exists:
        set_aside()
    try:
        put_in()
    except Exception:
        if exists:
            put_back()
        raise
    if exists:
        discard()


def overwrite_table(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Replace the parquet table at ``path`` by ``df``; returns ``path``."""
    spark = df.sparkSession
    base = path.rstrip("/")
    staging = f"{base}._staging"
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode("overwrite").parquet(staging)
    fs, target, jvm = _fs(spark, path)
    stage, old = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(f"{base}._previous")
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)  # left by a run that ended after its swap
        else:
            _rename(fs, old, target)  # left by a run that ended inside it
    _swap(fs.exists(target), lambda: _rename(fs, target, old), lambda: _rename(fs, stage, target),
          lambda: _rename(fs, old, target), lambda: fs.delete(old, True))
    return path


def _alter(spark, source: str, target: str) -> None:
    spark.sql(f"ALTER TABLE {source} RENAME TO {target}")


def overwrite_catalog_table(df: DataFrame, name: str, bucket_by: list[str] | None = None,
                            buckets: int | None = None, view: bool = False) -> str:
    """Replace catalog table ``name`` by ``df``.

    The data is written as ``<name>__staging``; then the old table is renamed,
    the staging table takes its name, and only then the old one is dropped (on
    failure it gets its name back). With ``view`` the data goes to a table with a name of
    its own and the view ``name`` is switched to it in one step, without a gap; of the
    tables of earlier runs the last one stays for readers that are still in it.

    With ``bucket_by`` (e.g. site_code, patient_pk) and ``buckets``, rows are
    hash-bucketed and sorted on those columns, so later windows and joins on
    the same key read co-located data and need no exchange.
    """
    spark = df.sparkSession
    staging = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}" if view else f"{name}__staging"
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets or 200, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(staging)
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {staging}")
        database, _, plain = name.rpartition(".")
        listed = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{plain}__v*'").collect()
        earlier = sorted(r["tableName"] for r in listed if r["tableName"] < staging.rpartition(".")[2].lower())
        for old in earlier[:-1]:
            spark.sql(f"DROP TABLE IF EXISTS {f'{database}.' if database else ''}{old}")
        return name
    previous = f"{name}__previous"
    if spark.catalog.tableExists(previous):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {previous}")
        else:
            _alter(spark, previous, name)
    _swap(spark.catalog.tableExists(name), lambda: _alter(spark, name, previous), lambda: _alter(spark, staging, name),
          lambda: _alter(spark, previous, name), lambda: spark.sql(f"DROP TABLE {previous}"))
    return name


def write_marker(spark, path: str, text: str) -> None:
    """Write a one-line marker file through the Hadoop file system (no Spark job)."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_marker(spark, path: str) -> str | None:
    """The marker's text, or None when there is no marker."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def remove_marker(spark, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, False)
