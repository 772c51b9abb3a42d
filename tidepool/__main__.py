"""Run registered queries from the command line.

    python -m tidepool list
    python -m tidepool <query> [<sf_dir>] [--out <path>] [--show N]

Without ``--out`` the first N rows are shown; with it the whole result is
written as Parquet.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidepool")
    ap.add_argument("query")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    from tidepool.plans.catalog import QUERIES
    if a.query == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query}; try: python -m tidepool list", file=sys.stderr)
        return 2
    from tidepool.session import build_session
    spark = build_session(a.master)
    df = QUERIES[a.query](spark, a.sf_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.show, truncate=80)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
