"""Print what stands out in the physical plan of each query."""

from __future__ import annotations

import pathlib
import re
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tablebridge.plans import catalog  # noqa: E402
from tablebridge.session import local_session  # noqa: E402

MARKS = {
    "CartesianProduct": r"CartesianProduct",
    "NestedLoop": r"BroadcastNestedLoopJoin",
    "PythonEval": r"BatchEvalPython|ArrowEvalPython",
    "SinglePartition": r"Exchange SinglePartition",
}


def main() -> None:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    # Without broadcasts small inputs show the plan that large ones get.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in sys.argv[1:] or catalog.QUERIES:
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = {k: len(re.findall(v, plan)) for k, v in MARKS.items()}
        counts = {
            "exchanges": len(re.findall(r"Exchange (?:hash|range|Round)", plan)),
            "scans": len(re.findall(r"FileScan", plan)),
            "windows": len(re.findall(r"Window \[", plan)),
        }
        odd = {k: v for k, v in found.items() if v}
        print(f"{name}: {counts} {odd or ''}")


if __name__ == "__main__":
    main()
