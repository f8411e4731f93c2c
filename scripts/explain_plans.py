"""Print the final physical plans (after AQE) of registered queries on stored inputs.

Usage: python scripts/explain_plans.py [sf_dir] [name ...] > PLANS.md
Each query runs once (no-op write) so AQE's final plan is shown; long
expressions are cut to keep the operator tree readable.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitlens.plans.fixtures import StoredTables  # noqa: E402
from hitlens.plans.registry import QUERIES  # noqa: E402
from hitlens.session import local_session, stored_table_path  # noqa: E402

WIDTH = 150


def tidy(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^]]*\]", "Location: ...", line)
    return line if len(line) <= WIDTH else line[: WIDTH - 3] + "..."


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(shuffle_partitions=16, app="hitlens-plans")
    tables = StoredTables.materialize(spark, sf_dir, stored_table_path(spark, "plan-inputs"))
    print(f"# Final physical plans at {os.path.basename(sf_dir)} (local[8], AQE on, stored inputs)\n")
    for name in names:
        df = QUERIES[name](tables)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this plan itself, so AQE's final plan is attached
        plan = qe.executedPlan().toString().split("+- == Initial Plan ==")[0]
        print(f"## {name}\n\n```")
        for line in plan.splitlines():
            print(tidy(line))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
