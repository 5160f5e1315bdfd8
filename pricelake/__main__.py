"""Command line: the three steps a user of the reference runs, as Spark jobs.

    python -m pricelake load  --root /shared/wh --sf-dir /root/testdata/sf0.1   # RAW tables
    python -m pricelake load  --root /shared/wh --csv /landing/prices --json /landing/companies
    python -m pricelake load  --root /shared/wh --csv /landing/prices --company-csv /landing/c.csv
    python -m pricelake build --root /shared/wh [--full-refresh]                # marts
    python -m pricelake test  --root /shared/wh [--as-of 2024-01-31]            # quality summary

Also usable with ``spark-submit pricelake/__main__.py ...``; without ``--master`` the session
takes its master from the submitting environment.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from pricelake.plans import warehouse
from pricelake.session import get_spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pricelake")
    p.add_argument("command", choices=["load", "build", "test"])
    p.add_argument("--root", required=True, help="warehouse folder every executor can reach")
    p.add_argument("--sf-dir", help="derive RAW from the driver tables in this folder")
    p.add_argument("--csv", help="price CSV files to load into RAW")
    p.add_argument("--json", help="company JSON-lines files to load into RAW")
    p.add_argument("--company-csv", help="company CSV file to load into RAW")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--as-of", help="reference date for the no-future-dates test")
    p.add_argument("--tickers", help="expected tickers, comma-separated, in place of the fixed list")
    p.add_argument("--master")
    a = p.parse_args(argv)

    spark = get_spark(a.master)
    if a.command == "load":
        if a.sf_dir:
            paths = warehouse.land_raw(spark, a.sf_dir, a.root)
        else:
            if not (a.csv and (a.json or a.company_csv)):
                p.error("load needs --sf-dir, or --csv and one of --json and --company-csv")
            paths = warehouse.load_csv(spark, a.csv, a.root)
            if a.company_csv:
                paths.update(warehouse.load_company_csv(spark, a.company_csv, a.root))
            else:
                paths["raw_company_metadata"] = warehouse.load_company_json(spark, a.json, a.root)
        for name, path in sorted(paths.items()):
            print(f"{name}\t{path}")
    elif a.command == "build":
        for name, path in warehouse.build(spark, a.root, full_refresh=a.full_refresh).items():
            print(f"{name}\t{path}")
    else:
        summary = warehouse.run_tests(spark, a.root, as_of=a.as_of,
                                      expected=a.tickers and a.tickers.split(","))
        failing = summary.filter(F.col("failures") > 0).orderBy("model", "rule", "column_name")
        rows = failing.collect()      # one row per failing rule: bounded by the rule count
        for r in rows:
            print(f"FAIL {r['model']}.{r['column_name']} {r['rule']}: {r['failures']} rows")
        print(f"{len(rows)} failing rules")
        return 1 if rows else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
