"""Print ``explain("formatted")`` for registered queries, with broadcasts
switched off so the plan is the one a cluster-sized input would get.

Usage: python tools/show_plans.py [sf_dir] name [name ...]
Each plan is followed by a one-line summary: parquet scans with their
read schemas and the columns every exchange carries.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sifter.plans import catalog  # noqa: E402
from sifter.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or ["dups_distribution", "word_counts"]
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    for name in names:
        df = catalog.REGISTRY[name].fn(spark, sf_dir)
        print(f"==== {name}")
        df.explain("formatted")
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
        print(f"---- {name}: {len(scans)} parquet scans; read columns: {sorted(set(scans))}")


if __name__ == "__main__":
    main()
