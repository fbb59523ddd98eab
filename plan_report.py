"""Write the physical plan tree of every registered query to PLANS_TREES.md.

    python plan_report.py [sf_dir]

Queries that run a write while being built (sinks, scans of written trees,
the pipeline) show the plan of the DataFrame they return.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from postlake.plans.driver import QUERIES
from postlake.session import local_session


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    head = buf.getvalue().split("\n\n")[0]
    return re.sub(r"#\d+", "", head)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans (generated by plan_report.py)", "", f"Tables: `{sf_dir}`, local[8], AQE on.", ""]
    for name, fn in QUERIES.items():
        out += [f"## {name}", "", "```", tree(fn(spark, sf_dir)), "```", ""]
    with open("PLANS_TREES.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
