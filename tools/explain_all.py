"""Write ``explain("formatted")`` of every dataset to docs/plans/<id>.txt.

    python tools/explain_all.py BASE_DIR   # BASE_DIR: <table>.parquet files (e.g. bench.py's base folder)

Broadcast joins are disabled so the plans show the shape large inputs get
(sort-merge joins, exchanges on the patient key, partial WindowGroupLimit).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cohortlake.params import FIXTURE_AS_OF  # noqa: E402
from cohortlake.plans.graph import DATASETS, DatasetGraph, query_name  # noqa: E402
from cohortlake.session import local_session  # noqa: E402
from cohortlake.sources.tables import TableSet  # noqa: E402


def main() -> None:
    base = sys.argv[1]
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    graph = DatasetGraph(TableSet(spark, base), FIXTURE_AS_OF)
    for ds in DATASETS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            graph.get(ds).explain("formatted")
        text = re.sub(r"file:[^\]]*/base/", "<base>/", buf.getvalue())
        text = re.sub(r"#\d+L?", "", text)
        with open(os.path.join(out_dir, f"{query_name(ds)}.txt"), "w") as fh:
            fh.write(text)
    spark.stop()


if __name__ == "__main__":
    main()
