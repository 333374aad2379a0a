"""Print the final (post-AQE) physical plan tree of registered queries.

    python tools/show_plans.py [--sf /root/testdata/sf0.1] kpis window_counts ...

Each query is executed once (``noop`` sink is not used because it plans a
separate write command; ``collect`` on a count keeps the query itself) and
its adaptive plan is printed as a compact operator tree.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compact(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        if line.strip().startswith("+- == Initial Plan =="):
            break
        line = re.sub(r"#\d+L?", "", line)
        out.append(line[:width])
    return "\n".join(out)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    from lumenlog.plans.catalog import queries
    from lumenlog.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    qs = queries()
    for name in args.names:
        df = qs[name](spark, args.sf)
        df.foreach(lambda _: None)           # run the query itself to completion
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n```\n{compact(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
