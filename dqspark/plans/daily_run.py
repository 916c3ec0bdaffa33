"""One scheduled quality run end to end (the reference's ``main()``).

Reads the healthcare tables, runs the checker's five checks once
(checkpointed), appends the audit rows, writes the quality metrics, the
report preview, the HTML report and the JSON export. Every output is written by the
executors, partitioned by run with dynamic overwrite, so rerunning the same
``run_id`` after a failure replaces its own output. Without a ``run_id`` every
run gets a new one and adds its rows.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics as MT
from ..sources.intake import take_in
from ..sources.readers import conform, read_csv_text, read_table
from ..sources.schemas import TABLES
from . import fused, sinks
from .checker import RunResult, run_all_checks

INPUT_TABLES = ("patient_records", "providers", "claims", "claims_line_items", "encounters")


@dataclass(frozen=True)
class DailyRunPaths:
    audit: str
    metrics: str
    preview: str
    export: str
    html: str

    @classmethod
    def under(cls, root: str) -> "DailyRunPaths":
        return cls(*(os.path.join(root, n) for n in ("quality_audit_log", "quality_metrics", "report_preview",
                                                      "results", "quality_report")))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its own file system (any Hadoop URI)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def last_id(spark: SparkSession, path: str, column: str, run_id: str) -> int:
    """The largest serial of the rows that runs other than ``run_id`` (which
    replaces its own) wrote under ``path``; 0 for none."""
    if not path_exists(spark, path):
        return 0
    return spark.read.parquet(path).filter(F.col("run_id") != run_id).agg(F.max(column)).first()[0] or 0


def _raw(spark: SparkSession, path: str, name: str, fmt: str) -> DataFrame:
    """A source's values before they are typed."""
    if fmt == "csv":
        return read_csv_text(spark, path, name)
    if fmt == "json":
        # Scalars are read as text whatever they hold; a record that is no JSON has no key and is rejected.
        schema = T.StructType([T.StructField(c.name, c.dtype if isinstance(c.dtype, T.ArrayType) else T.StringType())
                               for c in TABLES[name].columns])
        return spark.read.schema(schema).json(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet", audit_log: str | None = None,
                rejects: str | None = None) -> SimpleNamespace:
    """``root/<table>`` for each input table, conformed to its declared schema.

    Without ``rejects`` a value that does not fit the schema fails the read.
    With it, rows holding one are written as JSON to ``rejects/<table>`` with
    their reasons, and the run goes on with the others.

    ``audit_log`` names the log that M4 and M5 read and must exist; without
    it, ``root/quality_audit_log`` is read where there is one.
    """
    out = {}
    for name in INPUT_TABLES:
        path = os.path.join(root, name)
        if rejects:
            taken = take_in(_raw(spark, path, name, fmt), name)
            taken.rejected.write.mode("overwrite").option("ignoreNullFields", "false").json(os.path.join(rejects, name))
            out[name] = taken.accepted
        else:
            out[name] = conform(read_table(spark, path, name, fmt=fmt), TABLES[name])
    audit = audit_log or os.path.join(root, "quality_audit_log")
    if audit_log or path_exists(spark, audit):
        out["quality_audit_log"] = spark.read.parquet(audit)
    return SimpleNamespace(**out)


def daily_run(tables, as_of: dt.date, out_root: str, run_id: str | None = None,
              run_ts: dt.datetime | None = None) -> RunResult:
    """Run the checks and write every output under ``out_root``. ``run_ts`` is
    the clock unless given."""
    ts = run_ts or dt.datetime.now().replace(microsecond=0)
    rid = run_id or f"{ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    paths = DailyRunPaths.under(out_root)
    t = tables if not isinstance(tables, dict) else SimpleNamespace(**tables)
    spark = t.claims.sparkSession
    run = run_all_checks(tables, as_of, run_ts=ts, run_id=rid, materialize=True,
                         last_audit_id=last_id(spark, paths.audit, "audit_id", rid))
    metric_parts = dict(rates=fused.rate_values(fused.tallies(t, as_of)),
                        last_id=last_id(spark, paths.metrics, "metric_id", rid))
    log = getattr(t, "quality_audit_log", None)
    if log is not None:
        metric_parts.update(resolution=MT.resolution_times(log), trend=MT.weekly_error_trend(log))
    # M4 and M5 may read the log this run writes to: metrics go first.
    sinks.append_metrics(MT.metric_rows(as_of, ts, **metric_parts), paths.metrics, rid)
    sinks.append_audit(run.audit, paths.audit)
    sinks.write_partitioned(sinks.report_preview(run).withColumn("run_id", F.lit(rid)), paths.preview, "run_id")
    sinks.export_json(run, os.path.join(paths.export, rid))
    sinks.write_html_report(run, os.path.join(paths.html, rid), generated_at=ts.isoformat())
    return run
