"""Write PLANS.md: the physical plan tree of every registered query (sf0.01 inputs)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.plans.registry import QUERIES  # noqa: E402
from barlake.session import build_session  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line if len(line) <= 150 else line[:147] + "...")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    parts = ["# Physical plans of the registered queries\n",
             "Generated by `python tools/dump_plans.py` (local[8], AQE initial plans, test data "
             "sf0.01). Silver, the ticker dimension and Gold are written lake tables (see README), "
             "but for `stg_stock_prices` and the trades, which are computed; `Exchange` = shuffle.\n"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        parts.append(f"## {name}\n\n```\n{tree(df)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
