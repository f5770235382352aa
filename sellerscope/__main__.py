"""Command line: ``python -m sellerscope {train,score,dashboard} ...``.

``--data`` is a folder of marketplace extracts (CSV with the registry's
file names, or parquet) or, with ``--testdata``, a folder of the TPC-H-like
test tables mapped by the fixture adapter.
"""

from __future__ import annotations

import argparse
import os

from sellerscope.config import ChurnParams


def _tables(spark, args):
    if args.testdata:
        from sellerscope.sources.fixture import funnel_tables
        return funnel_tables(spark, args.data)
    from sellerscope.sources.registry import TableRegistry, parse_dates
    return parse_dates(TableRegistry(spark, args.data, args.format).load_all())


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="sellerscope")
    ap.add_argument("command", choices=("train", "score", "dashboard"))
    ap.add_argument("--data", required=False)
    ap.add_argument("--out", required=True)
    ap.add_argument("--models", default=None)
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--testdata", action="store_true")
    ap.add_argument("--never-activated-days", type=int, default=90)
    ap.add_argument("--dormant-days", type=int, default=60)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from sellerscope.plans import runs
    from sellerscope.session import SCALE_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.appName("sellerscope")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    params = ChurnParams(never_activated_days=args.never_activated_days, dormant_days=args.dormant_days)
    if args.command == "train":
        runs.run_training(spark, _tables(spark, args), args.out, params)
    elif args.command == "score":
        model_dir = args.models or os.path.join(args.out, "models")
        dist = runs.run_inference(spark, _tables(spark, args), model_dir,
                                      os.path.join(args.out, "seller_risk_scores_inference"), params)
        dist.show()
    else:
        for name, df in runs.dashboard_tables(spark, args.out, params).items():
            df.write.mode("overwrite").json(os.path.join(args.out, "dashboard", name))
    spark.stop()


if __name__ == "__main__":
    main()
