"""Run one registered job from the command line.

    python -m bizlens list
    python -m bizlens run <job> [--sf-dir DIR] [--rows N] [--sort] [--explain]
    python -m bizlens sql <job>          # print the job's oracle SQL
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="bizlens")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered jobs")
    run = sub.add_parser("run", help="run one job and show its result")
    run.add_argument("job")
    run.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    run.add_argument("--rows", type=int, default=20)
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    run.add_argument("--sort", action="store_true", help="sort the result of a job with a row per fact, too")
    sql = sub.add_parser("sql", help="print the job's oracle SQL")
    sql.add_argument("job")
    args = parser.parse_args(argv)

    from bizlens import catalog

    if args.cmd == "list":
        for name in catalog.queries():
            print(name)
        return 0
    if args.cmd == "sql":
        print(catalog.oracle_sql()[args.job])
        return 0
    from bizlens.session import local_session

    spark = local_session(8)
    df = catalog.queries()[args.job](spark, args.sf_dir)
    if args.sort:
        df = catalog.sorted_rows(args.job, df)
    if args.explain:
        df.explain("formatted")
    df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
