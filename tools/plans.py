"""Write the final (post-AQE) physical plans of the headline models to PLANS.md.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MODELS = ("event_detail", "dim_events", "hybrid_risk", "name_similarity_pairs", "dim_members", "fact_attendance",
          "ticket_attendance", "dq_summary")


def _clean(plan: str, width: int = 170) -> str:
    from flocklens.functions.text import UNICODE_WHITESPACE

    plan = plan.replace(UNICODE_WHITESPACE, "<unicode-ws>")
    plan = plan.split("+- == Initial Plan ==")[0]
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]|\[id=#?\d+\]", "", line)
        out.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(out)


def main() -> None:
    from flocklens.plans.catalog import QUERIES, fixture_build
    from flocklens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(scratch=tempfile.mkdtemp(prefix="flocklens-plans-"))
    parts = [
        "# Physical plans of the headline models\n",
        f"Generated by `tools/plans.py` on `{sf_dir}` (local[8]), each from a fresh build. Attribute ids stripped,",
        "long lines cut. Written intermediates appear as Parquet scans. Each model comes as AQE ran it on this",
        "small input (small sides broadcast), and with broadcasts off, the shape it has at scale.\n",
    ]
    for name in MODELS:
        for threshold in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            b = fixture_build(spark, sf_dir, shared=False)
            df = QUERIES[name](b)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            how = "broadcasts off" if threshold == "-1" else "as run"
            parts.append(f"## {name}, {how}\n\n```\n{_clean(plan)}\n```\n")
            b.close()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
