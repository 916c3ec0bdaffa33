"""``python -m dqspark --tables DIR --out DIR [--as-of YYYY-MM-DD] [--run-id ID] [--audit-log DIR] [--rejects DIR]``

Runs one quality run over the tables stored under ``--tables`` (one folder
per table) and writes the audit log, metrics, report preview and JSON
results under ``--out``. Uses the active session configuration (cluster
master, ``spark.checkpoint.dir``) when launched with spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans.daily_run import daily_run, load_tables
from .session import CLUSTER_CONF, DEFAULT_CONF, apply_defaults, checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="dqspark")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    ap.add_argument("--rejects", default=None, help="folder for rows that don't fit the schema; without it they fail the run")
    ap.add_argument("--audit-log", default=None, help="log read by the resolution and trend metrics; must exist")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("dqspark-run").getOrCreate()
    apply_defaults(spark, {k: v for k, v in DEFAULT_CONF.items() if not k.startswith("spark.ui")})
    apply_defaults(spark, CLUSTER_CONF)
    checkpoint_dir(spark)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    run = daily_run(load_tables(spark, args.tables, args.format, args.audit_log, args.rejects), as_of, args.out, run_id=args.run_id)
    run.summary.show(truncate=False)


if __name__ == "__main__":
    main()
