"""Command line for the batch programs (run with spark-submit or ``python -m tarmac``).

  load        --flights CSV --airports CSV --root DIR --version N
  downstream  --root DIR --version N [--from-version M]
  questions   --root DIR --version N          (prints Q-01, Q-02, Q-03, Q-05, Q-06)
  replace     --root DIR --version N --to-version M [--src BOS --tgt TST]

Tables live under ``--root`` (a shared folder) as ``<table>/v=<version>``; every
program writes a new version and never overwrites what it reads. Cluster settings
(master, executors, shuffle partitions, checkpoint dir) come from spark-submit.
"""

from __future__ import annotations

import argparse
import sys

from tarmac.plans import jobs
from tarmac.plans.replace import SOURCE_CODE, TARGET_CODE
from tarmac.session import build_session


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tarmac")
    sub = p.add_subparsers(dest="program", required=True)
    load = sub.add_parser("load")
    load.add_argument("--flights", required=True)
    load.add_argument("--airports", required=True)
    for name in ("load", "downstream", "questions", "replace"):
        sp = load if name == "load" else sub.add_parser(name)
        sp.add_argument("--root", required=True)
        sp.add_argument("--version", type=int, required=True)
    sub.choices["downstream"].add_argument("--from-version", type=int)
    rep = sub.choices["replace"]
    rep.add_argument("--to-version", type=int, required=True)
    rep.add_argument("--src", default=SOURCE_CODE)
    rep.add_argument("--tgt", default=TARGET_CODE)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or build_session(app=f"tarmac-{args.program}")
    at = jobs.Version(args.root, args.version)
    if args.program == "load":
        metrics = jobs.load(spark, args.flights, args.airports, at)
        print(f"loaded {metrics['rows']} flights into {at.path('flights')}")
        return metrics
    if args.program == "downstream":
        src = jobs.Version(args.root, args.version if args.from_version is None else args.from_version)
        jobs.downstream(spark, src, at)
        print(f"wrote airport_departures and flights_airtime version {args.version}")
        return {}
    if args.program == "questions":
        answers = {k: [r.asDict() for r in df.collect()] for k, df in jobs.questions(spark, at, at).items()}
        for k, v in answers.items():
            print(k, v)
        return answers
    counts = jobs.replace_airport_code(spark, at, at, jobs.Version(args.root, args.to_version),
                                       args.src, args.tgt)
    rows = [r.asDict() for r in counts.orderBy("step").collect()]
    for r in rows:
        print(f"step {r['step']}: {r['table_name']}.{r['column_name']} {r['matched_rows']} rows")
    return {"counts": rows}


if __name__ == "__main__":
    main()
