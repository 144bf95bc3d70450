"""Benchmark: the 23 datasets on the fixture tables at $BENCH_SF_DIR.

1. The adapter turns the driver's test tables into the clinical base tables
   and writes them once as parquet, ``$BENCH_CPUS`` files per table, laboratory
   results clustered by test (timed as ``load_base_tables``).
2. Each dataset is computed from those tables and fully materialised with the
   ``noop`` sink (upstream datasets are computed inside, as a user would run
   it); one warm-up, then the median of ``$BENCH_RUNS`` runs.
3. ``refresh_all`` runs the full dependency-ordered refresh, writing all 23
   tables (upstream tables are read back, cutting lineage).

Prints one JSON line; ``value`` is the sum of the per-dataset medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlake.params import FIXTURE_AS_OF  # noqa: E402
from cohortlake.plans.graph import DATASETS, DatasetGraph, query_name  # noqa: E402
from cohortlake.plans.refresh import refresh  # noqa: E402
from cohortlake.session import local_session  # noqa: E402
from cohortlake.sources.adapter import TABLES, FixtureTables  # noqa: E402
from cohortlake.sources.clustering import write_base_table  # noqa: E402
from cohortlake.sources.tables import TableSet  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = local_session(cpus, partitions, app="cohortlake-bench")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    t0 = time.time()
    fixtures = FixtureTables(spark, sf_dir)
    for name in TABLES:
        # several files per table (as real tables have), so scans run in parallel
        write_base_table(getattr(fixtures, name), f"{scratch}/base", name, partitions=cpus)
    load_sec = round(time.time() - t0, 3)

    tables = TableSet(spark, f"{scratch}/base")
    queries: dict[str, float] = {}
    for ds_id in DATASETS:
        samples = []
        for i in range(runs + 1):
            df = DatasetGraph(tables, FIXTURE_AS_OF).get(ds_id)
            t = time.time()
            df.write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.time() - t)
        queries[query_name(ds_id)] = round(statistics.median(samples), 3)

    t = time.time()
    refresh(spark, tables, FIXTURE_AS_OF, f"{scratch}/out")
    refresh_sec = round(time.time() - t, 3)

    print(json.dumps({
        "metric": "sum_of_dataset_medians",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "load_base_tables": load_sec,
        "refresh_all": refresh_sec,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "shuffle_partitions": partitions,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
