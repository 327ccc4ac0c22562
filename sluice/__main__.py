"""Command line: ``python -m sluice run ...``.

``run``       bronze -> silver -> gold -> forecast over the provided tables,
              printing the layer audit and the forecast run record.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from sluice.config import LakeConfig
from sluice.plans.layers import run_test_layers
from sluice.session import local_session


def run_command(args, spark) -> None:
    lake = LakeConfig(root=args.lake) if args.lake else None
    run = run_test_layers(spark, args.sf_dir, lake=lake, horizon=args.horizon, holdout=args.holdout,
                     forecast_model=args.model)
    run.audit.show(truncate=False)
    run.store.read("gold", "forecast_runs").orderBy(F.desc("run_at")).show(truncate=False)
    print(f"tables written under {run.store.lake.root}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="sluice")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run every layer over the provided tables")
    r.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    r.add_argument("--lake", help="lake root (default: a new folder under spark.checkpoint.dir)")
    r.add_argument("--horizon", type=int, default=6)
    r.add_argument("--holdout", type=int, default=2)
    r.add_argument("--model", choices=("seasonal", "trend"), default="seasonal")
    r.add_argument("--cores", default="*")
    r.set_defaults(fn=run_command)
    args = p.parse_args(argv)
    spark = local_session(args.cores)
    spark.sparkContext.setLogLevel("ERROR")
    try:
        args.fn(args, spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
