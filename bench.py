"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS]; prints one JSON line.

Each query is forced to completion with the ``noop`` sink (the full plan
runs, nothing is collected to the driver).  The headline metric is the
total wall time of the set; ``full_features`` alone is the reference's
"featurise every match" job, which it could only run on samples.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_master",
    "goal_aggregates",
    "team_records",
    "top_teams_win_pct",
    "key_findings",
    "score_matrix",
    "h2h_last_n",
    "last5_form",
    "full_features",
    "asof_team_state",
    "cv_folds",
    "roc_auc",
    "ingest_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    os.environ["BENCH_CPUS"] = str(cpus)
    from matchstats.plans.registry import all_queries
    from matchstats.session import get_session

    spark = get_session(f"local[{cpus}]", max(cpus, 8))
    reg = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    # warm-up: JVM, parquet footers, codegen caches
    reg["team_records"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
