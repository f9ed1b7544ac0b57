"""Print, per registered query, the physical operators that matter at scale:
shuffles (Exchange), broadcasts, sorts, windows, Python evaluation and scans."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.plans.registry import QUERIES  # noqa: E402
from barlake.session import build_session  # noqa: E402

KEYS = ("Exchange", "BroadcastExchange", "Sort ", "Window", "WindowGroupLimit", "SortAggregate",
        "HashAggregate", "ArrowEvalPython", "BatchEvalPython", "TakeOrderedAndProject", "Generate")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k.strip(): len(re.findall(r"(?<![A-Za-z])" + re.escape(k), plan)) for k in KEYS}
        shuffles = len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|"
                                  r"SinglePartition|RoundRobinPartitioning)", plan))
        print(f"{name:24s} shuffles={shuffles} " + " ".join(f"{k}={v}" for k, v in counts.items() if v))
    spark.stop()


if __name__ == "__main__":
    main()
