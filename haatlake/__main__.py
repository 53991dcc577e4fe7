"""Clean, load and explore from the command line, each step or all of them.

    spark-submit ... -m haatlake all --raw /data/raw --out /data/out --prefix sales_
    python -m haatlake load --raw /data/more --out /data/out --append

`clean` writes the cleaned dataset and its quality report, `load` the warehouse, `explore` every panel
of the analyses (out/explore/<analysis>/<panel>). What is complete under --out is opened, not built again;
--replace builds it anew. --append cleans the files of --raw and adds them to the warehouse there.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import explore, views
from .plans.session import STATIC
from .plans.workspace import Workspace
from .sources.files import load_raw_data

STEPS = ("clean", "load", "explore")


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="haatlake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=(*STEPS, "all"))
    parser.add_argument("--raw", help="folder of the yearly files and the product catalog", required=True)
    parser.add_argument("--out", help="folder of the results", required=True)
    parser.add_argument("--prefix", default="sales_", help="how names of yearly files begin")
    parser.add_argument("--encoding", default="auto", help="auto: latin-1 for files that aren't UTF-8")
    how = parser.add_mutually_exclusive_group()
    how.add_argument("--append", action="store_true", help="add the files to the warehouse that is there")
    how.add_argument("--replace", action="store_true", help="build what is there anew")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str]) -> dict[str, object]:
    """What was done: row counts of the warehouse, names of failed analyses."""
    args, done = arguments(argv), {}
    steps = STEPS if args.step == "all" else (args.step,)
    options = {"prefix": args.prefix, "encoding": args.encoding}
    ws = Workspace.from_files(spark, args.raw, out_dir=args.out, **options)
    if args.append:
        done["rows"] = {r[0]: r[1] for r in ws.append(load_raw_data(spark, args.raw, **options)[0]).collect()}
        steps = ()
    if args.replace:
        ws.rebuild(("cleaned", "warehouse") if "clean" in steps else ("warehouse",) if "load" in steps else ())
    if "clean" in steps:
        ws.cleaned
    if "load" in steps:
        done["rows"] = {r[0]: r[1] for r in ws.warehouse.row_counts().collect()}
        done["views"] = views.register_views(ws.warehouse)
    if "clean" in steps and "load" in steps:
        ws.report()
    if "explore" in steps:
        write = lambda analysis, panel, frame: frame.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/explore/{analysis}/{panel}")
        found, failed = explore.run_all(ws.cleaned, sink=write)
        done |= {"analyses": sorted(found), "failed": {k: str(e) for k, e in failed.items()}}
    return done


def main() -> int:
    spark = SparkSession.builder.appName("haatlake").config(map=STATIC).getOrCreate()
    done = run(spark, sys.argv[1:])
    for key, value in done.items():
        print(f"{key}: {value}")
    return 1 if done.get("failed") else 0


if __name__ == "__main__":
    sys.exit(main())
