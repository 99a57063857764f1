"""Run registered queries against their DuckDB oracle and print one line each.

usage: python scripts/check_all.py [sf_dir] [name ...]
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlens.plans.catalog import load_all  # noqa: E402
from roadlens.plans.check import compare, duck_connect  # noqa: E402
from roadlens.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(load_all())
    spark = build_session()
    con = duck_connect(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        ok = r.get("exact") or r.get("approx") or (r.get("oracle", 1) is None and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + json.dumps(r, default=str), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
