"""Tables as folders of versions and commits: full refreshes without a moment of absence.

    <path>/v-<time>-<id>/               the files of a version
    <path>/_commits/<time>+<version>    an empty file that makes the version the current one

A new version is written beside the old ones; creating its commit file, one atomic step on HDFS,
POSIX file systems and object stores alike, switches the readers, who take the version of
the newest commit. Nothing that readers look at is ever replaced or absent, so they see the old
table or the new one, never none. Old versions stay for readers that are still in them: the last ``keep``
before the current one, and all that were replaced less than ``grace`` seconds ago; others
go at the next commit. A run that dies before its commit leaves a version that no commit names; it
goes the same way.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlake.sources.sink import _fs, write_marker

COMMITS = "_commits"
#: Seconds that a replaced version stays at least: no reader should take longer.
GRACE = 6 * 3600


def _names(spark: SparkSession, folder: str, start: str = "") -> list[str]:
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(name for name in (s.getPath().getName() for s in fs.listStatus(p)) if name.startswith(start))


def _commit(spark: SparkSession, base: str, version: str) -> None:
    """Make ``version`` the current one."""
    write_marker(spark, f"{base}/{COMMITS}/{time.time_ns():020d}+{version}", "")


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that readers take, or None if ``path`` is no versioned table."""
    base = path.rstrip("/")
    commits = _names(spark, f"{base}/{COMMITS}")
    return f"{base}/{commits[-1].partition('+')[2]}" if commits else None


def commit(df: DataFrame, path: str, partitions: int | None = None, keep: int = 1, grace: float = GRACE) -> str:
    """Write ``df`` as the new current version of the table at ``path``; returns its folder.

    ``keep`` old versions stay, and those that were replaced less than ``grace`` seconds ago. Versions
    that began after the current one (another run is writing them) are left alone."""
    spark, base = df.sparkSession, path.rstrip("/")
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    out = df if partitions is None else df.repartition(partitions)
    out.write.parquet(f"{base}/{name}")
    _commit(spark, base, name)
    fs, _, jvm = _fs(spark, base)
    commits = _names(spark, f"{base}/{COMMITS}")
    replaced = {c.partition("+")[2]: int(after.partition("+")[0]) / 1e9 for c, after in zip(commits, commits[1:], strict=False)}
    kept = {c.partition("+")[2] for c in commits[-keep - 1 :]}
    for version in _names(spark, base, "v-"):
        # an uncommitted version counts as replaced when it was begun; later ones are being written
        since = replaced.get(version, int(version.split("-")[1]) / 1e9)
        if version <= name and version not in kept and since <= time.time() - grace:
            for old in [f"{base}/{version}", *(f"{base}/{COMMITS}/{c}" for c in commits if c.partition("+")[2] == version)]:
                fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)
    return f"{base}/{name}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``, or the plain parquet table that is there."""
    folder = current(spark, path)
    return spark.read.parquet(folder or path)
