"""Versioned folders: readers that poll during swaps always find a whole table."""

import os
import threading

import pytest

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans.refresh import refresh
from cohortlake.sources import sink, versioned
from cohortlake.sources.adapter import FixtureTables
from cohortlake.sources.tables import read_table
from tests.conftest import rows


def test_readers_polling_during_swaps_never_fail(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    versioned.commit(spark.range(100), path)
    stop, seen, failed = threading.Event(), [], []

    def poll():
        while not stop.is_set():
            try:
                seen.append(versioned.read(spark, path).count())
            except Exception as e:  # noqa: BLE001
                failed.append(repr(e)[:300])

    readers = [threading.Thread(target=poll) for _ in range(3)]
    for r in readers:
        r.start()
    for n in range(101, 109):
        versioned.commit(spark.range(n), path, keep=2)  # within the grace, readers keep their version
    stop.set()
    for r in readers:
        r.join()
    assert not failed and set(seen) <= set(range(100, 109)) and len(set(seen)) > 2
    assert versioned.read(spark, path).count() == 108
    versioned.commit(spark.range(109), path, keep=2, grace=0)
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == 3


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t.parquet"
    versioned.commit(spark.range(3), path)
    real = versioned._commit
    monkeypatch.setattr(versioned, "_commit", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        versioned.commit(spark.range(9), path)
    assert versioned.read(spark, path).count() == 3
    monkeypatch.setattr(versioned, "_commit", real)
    for n in (4, 5, 6):
        versioned.commit(spark.range(n), path, grace=0)
    assert versioned.read(spark, path).count() == 6
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == 2  # the orphan went with the old ones


def test_plain_tables_are_read_as_they_are(spark, tmp_path):
    sink.overwrite_table(spark.range(3), f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 3


def test_gapless_refresh_into_folders_and_views(spark, tmp_path):
    tables = FixtureTables(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        refresh(spark, tables, FIXTURE_AS_OF, str(tmp_path), only=["d05"], gapless=True)
    refresh(spark, tables, FIXTURE_AS_OF, f"{tmp_path}/plain", only=["d05"])
    want = rows(read_table(spark, f"{tmp_path}/plain", "d05_last_encounter_as_at"))
    assert rows(read_table(spark, str(tmp_path), "d05_last_encounter_as_at")) == want
    spark.sql("CREATE DATABASE IF NOT EXISTS gapless")
    for _ in range(3):
        refresh(spark, tables, FIXTURE_AS_OF, None, only=["d04"], database="gapless", gapless=True)
    assert rows(spark.table("gapless.d04_dispense_as_at")) == rows(read_table(spark, f"{tmp_path}/plain", "d04_dispense_as_at"))
    assert len(spark.sql("SHOW TABLES IN gapless LIKE 'd04_dispense_as_at__v*'").collect()) == 2
