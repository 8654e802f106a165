"""Print plan red flags for every registered query (no execution beyond planning).

Usage: python tools/plan_audit.py [sf_dir]
Flags: cartesian products, nested-loop joins, row-at-a-time Python UDFs,
single-partition exchanges, and whether Parquet scans prune columns.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import get_session  # noqa: E402

FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition",
         "MapInPandas", "ArrowEvalPython"]

SKIP: set[str] = set()  # every query is planned; those with models fit them first


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[8]", conf={"spark.ui.showConsoleProgress": "false"})
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain()
        plan = buf.getvalue()
        found = {f: plan.count(f) for f in FLAGS if f in plan}
        scans = plan.count("FileScan parquet")
        print(f"{name:24s} scans={scans} {found}")


if __name__ == "__main__":
    main(sys.argv)
