"""Run the local oracle comparison for all (or selected) registered queries.

usage: python scripts_check.py [--oracle-only] [sf_dir] [name ...]
"""

import json
import sys

from matchstats.plans.compare import compare, duck_connection
from matchstats.plans.registry import all_queries
from matchstats.session import get_session

if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    oracle_only = "--oracle-only" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    spark = get_session()
    con = duck_connection(sf)
    reg = all_queries()
    bad = 0
    for name, (fn, sql) in reg.items():
        if (names and name not in names) or (oracle_only and sql is None):
            continue
        try:
            r = compare(spark, name, fn, sql, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": "ERROR", "detail": str(e)[:600]}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    print(json.dumps({"failed": bad, "total": len(names) or len(reg)}))
