"""Full refresh of all 23 datasets in dependency order.

Each dataset is written with the staging-and-swap sink; datasets that others
depend on (D01, D02, D04, D06, D08, D09) are read back from their written
table, which cuts the lineage: a lost executor later in the run recomputes
from the shared files, not from the base tables. The clinical visits are reduced
once for all datasets that rank them per key (``visit_pass``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from cohortlake.params import AsOf
from cohortlake.plans import KEY, visit_pass
from cohortlake.plans.graph import DATASETS, DatasetGraph
from cohortlake.sources import versioned
from cohortlake.sources.sink import overwrite_catalog_table, overwrite_table, read_marker, remove_marker, write_marker
from cohortlake.sources.tables import read_table

UPSTREAM = sorted({u for _, ups in DATASETS.values() for u in ups})


def _marker(path: str) -> str:
    return path + "._as_of"


def _completed(spark: SparkSession, path: str, as_of) -> bool:
    """True when ``path`` was fully written for this reporting date (the
    marker is written only after the table has been swapped in)."""
    return read_marker(spark, _marker(path)) == AsOf.of(as_of).day.isoformat()


def _mark(spark: SparkSession, path: str, as_of) -> None:
    write_marker(spark, _marker(path), AsOf.of(as_of).day.isoformat())


def _visit_candidates(spark: SparkSession, tables, as_of, out_dir: str | None, database: str | None, wanted: set[str],
                      resume: bool) -> DataFrame | None:
    """The visits reduced once for all wanted datasets that rank them per key, written
    and read back; None where less than two of them are wanted."""
    users = sorted(wanted & visit_pass.USES.keys())
    if len(users) < 2:
        return None
    kinds = sorted({k for u in users for k in visit_pass.USES[u]})
    if database:
        table = f"{database}.visit_candidates"
        overwrite_catalog_table(visit_pass.candidates(tables.ct_patient_visits, as_of, kinds), table)
        return spark.table(table)
    path, done = f"{out_dir.rstrip('/')}/visit_candidates", f"{AsOf.of(as_of).day.isoformat()} {','.join(kinds)}"
    if not (resume and read_marker(spark, _marker(path)) == done):
        remove_marker(spark, _marker(path))
        overwrite_table(visit_pass.candidates(tables.ct_patient_visits, as_of, kinds), path)
        write_marker(spark, _marker(path), done)
    return spark.read.parquet(path)


def refresh(spark: SparkSession, tables, as_of, out_dir: str | None, only: list[str] | None = None,
            database: str | None = None, buckets: int | None = None, resume: bool = False,
            gapless: bool = False) -> dict[str, float]:
    """Build every dataset (or ``only`` these and what they need) into
    ``<out_dir>/<id>_<name>.parquet``, or, with ``database``, into catalog
    tables ``<database>.<id>_<name>`` bucketed by the patient key when
    ``buckets`` is given; returns seconds per dataset.

    With ``gapless``, readers never find a table absent: folders hold versions with one
    pointer (read them with ``read_table`` or ``versioned.read``), catalog tables are views.

    With ``resume`` (folder output), datasets already completed for the same
    reporting date by an earlier, interrupted run are not rebuilt (reported
    as -1); they are still read back for the datasets that depend on them."""
    wanted = set(only or DATASETS)
    stack = list(wanted)
    while stack:
        for u in DATASETS[stack.pop()][1]:
            if u not in wanted:
                wanted.add(u)
                stack.append(u)
    written: dict = {}
    timings: dict[str, float] = {}
    reduced = _visit_candidates(spark, tables, as_of, out_dir, database, wanted, resume)
    for ds_id, (name, _) in DATASETS.items():
        if ds_id not in wanted:
            continue
        graph = DatasetGraph(tables, as_of, overrides=written, visit_candidates=reduced)
        t0 = time.time()
        path = f"{out_dir.rstrip('/')}/{ds_id}_{name}.parquet" if out_dir else None
        if resume and path and not database and _completed(spark, path, as_of):
            timings[ds_id] = -1.0
            if ds_id in UPSTREAM:
                written[ds_id] = read_table(spark, out_dir, f"{ds_id}_{name}")
            continue
        df = graph.get(ds_id)
        if database:
            table = f"{database}.{ds_id}_{name}"
            keyed = buckets and all(c in df.columns for c in KEY)
            overwrite_catalog_table(df, table, KEY if keyed else None, buckets, view=gapless)
        else:
            remove_marker(spark, _marker(path))   # a half-swapped table never looks finished
            versioned.commit(df, path) if gapless else overwrite_table(df, path)
            _mark(spark, path, as_of)
        timings[ds_id] = round(time.time() - t0, 3)
        if ds_id in UPSTREAM:
            written[ds_id] = spark.table(table) if database else read_table(spark, out_dir, f"{ds_id}_{name}")
    return timings


def main(argv: list[str] | None = None) -> None:
    """``python -m cohortlake.plans.refresh --tables DIR --out DIR [--as-of DATE] [--only d07 ...]``

    Runs on the active session (``spark-submit``) or a local one."""
    import argparse
    import datetime as dt
    import json

    from cohortlake.session import with_settings
    from cohortlake.sources.tables import TableSet

    p = argparse.ArgumentParser(description="Full refresh of the patient datasets")
    p.add_argument("--tables", required=True, help="folder with <table>.parquet base tables")
    p.add_argument("--out", help="output folder (shared storage)")
    p.add_argument("--database", help="write catalog tables in this database instead of --out")
    p.add_argument("--buckets", type=int, help="bucket catalog tables by the patient key")
    p.add_argument("--resume", action="store_true", help="skip datasets already written for this --as-of")
    p.add_argument("--gapless", action="store_true", help="versioned folders, or views, so that readers never find a table absent")
    p.add_argument("--as-of", default=dt.date.today().isoformat(), help="reporting date, default today")
    p.add_argument("--only", nargs="*", help="dataset ids, e.g. d07 d09 (their upstream is built too)")
    args = p.parse_args(argv)
    spark = with_settings(SparkSession.builder).getOrCreate()
    if not (args.out or args.database):
        p.error("one of --out or --database is required")
    timings = refresh(spark, TableSet(spark, args.tables), args.as_of, args.out, args.only, args.database,
                      args.buckets, args.resume, args.gapless)
    print(json.dumps(timings))


if __name__ == "__main__":
    main()
