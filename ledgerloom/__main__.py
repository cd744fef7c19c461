"""Command line: ``python -m ledgerloom run --sf DIR --out DIR`` builds every
model; ``python -m ledgerloom sql --sf DIR "SELECT ..."`` runs a read-only
statement over them and prints JSON."""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--sf", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--seeds", default=None, help="folder of seed files (<name>.csv)")
    q = sub.add_parser("sql")
    q.add_argument("--sf", required=True)
    q.add_argument("--out", default=None)
    q.add_argument("--seeds", default=None)
    q.add_argument("statement")
    a = ap.parse_args(argv)

    from .plans.context import Lake
    from .plans.read_only import read_only_pages
    from .plans.run import run_models
    from .plans.sinks import run_folder
    from .session import build_session

    spark = build_session()
    lake = Lake(spark, a.sf, seeds=a.seeds)
    out = a.out or run_folder(spark)
    models = run_models(lake, out)
    if a.cmd == "run":
        for name, df in models.items():
            print(f"{name}\t{df.count()}")
        return 0
    for page in read_only_pages(spark, a.statement):
        print(page)
    return 0


if __name__ == "__main__":
    sys.exit(main())
