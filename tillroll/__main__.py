"""Command line: ``spark-submit`` this file, or ``python -m tillroll``, with a job name and its parameters."""

import argparse
import json
import sys
from datetime import date

from tillroll.plans.jobs import PRODUCT_ROWS, Config, run_discovery, run_gold, run_reports, run_silver
from tillroll.session import build_session

JOBS = {"discovery": run_discovery, "silver": run_silver, "gold": run_gold, "reports": run_reports}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillroll")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--base-uri", required=True, help="bucket or folder that holds both paths")
    parser.add_argument("--in-path", required=True)
    parser.add_argument("--out-path", default="", help="not used by discovery")
    parser.add_argument("--database", required=True, help="catalog database of the silver and gold tables")
    parser.add_argument("--reporting-database", default="reporting")
    parser.add_argument("--raw-database", default="raw", help="catalog database of the raw datasets, for discovery")
    parser.add_argument("--as-of", type=date.fromisoformat, help="load and snapshot date, by default today")
    parser.add_argument("--load-date", type=date.fromisoformat, help="gold: read only this day's silver rows")
    parser.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    parser.add_argument("--silver-format", default="parquet")
    parser.add_argument("--gold-format", default="parquet")
    parser.add_argument("--product-rows", choices=PRODUCT_ROWS, default="newest", help="gold: which rows of a product count")
    parser.add_argument("--incremental", action="store_true", help="gold: from the states of the days")
    parser.add_argument("--infer-schema", action="store_true", help="silver: infer the raw types")
    args = vars(parser.parse_args(argv))
    job = JOBS[args.pop("job")]
    result = job(build_session(), Config(**args))
    if result:
        print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
