"""Sinks: audit-log and metrics tables, the report preview (P07), JSON and
CSV exports (P08, R4).

Writes are idempotent per run: the audit log and the metrics table are
partitioned by ``run_id`` (and ``metric_date``) and written with dynamic
partition overwrite, so a retried job replaces its own partition instead of
duplicating it, while every new run adds a partition (the append-only log of
the reference).
"""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from .checker import RunResult


def preview_order() -> dict:
    """How each check's preview is ordered: the reference's ORDER BY where it
    has one, then the record id so the first rows are deterministic."""
    return {
        "patient_completeness": ([], "patient_id"),
        "claims_discrepancies": ([F.col("discrepancy_amount").desc()], "claim_id"),
        "temporal_anomalies": ([], "claim_id"),
        "duplicate_records": ([F.col("duplicate_count").desc()], "first_id"),
        "provider_credentials": ([F.col("license_expiry_date").asc()], "provider_id"),
    }


def write_partitioned(df: DataFrame, path: str, *partition_cols: str, fmt: str = "parquet") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def append_audit(audit: DataFrame, path: str) -> None:
    """W1 sink: one job appends the run's audit rows (partition ``run_id``)."""
    write_partitioned(audit, path, "run_id")


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """M6 sink: metric rows, partitions ``metric_date`` and ``run_id``: only a
    retry of the same run replaces rows."""
    write_partitioned(metrics.withColumn("run_id", F.lit(run_id)), path, "metric_date", "run_id")


def report_preview(run: RunResult, n: int = R.REPORT_PREVIEW_ROWS) -> DataFrame:
    """For each check with findings, its first ``n`` detail rows.

    Columns: check_key, check_name, issues_found, preview_rank, record_id,
    row_json. Each preview is a top-``n`` (TakeOrderedAndProject: bounded
    per task, no full sort); the five previews and the five counts are tiny.
    """
    parts = []
    orders = preview_order()
    for key, check in run.checks.items():
        order, id_expr = orders[key]
        id_col = F.col(id_expr) if isinstance(id_expr, str) else id_expr
        d = check.base.select("*", id_col.cast("string").alias("_record_id"))
        top = d.orderBy(*order, F.col("_record_id")).limit(n)
        # A window over the ≤ n rows left after the top-n: one small task.
        w = Window.orderBy(*order, F.col("_record_id"))
        fields = list(check.base.columns)
        parts.append(top.select(
            F.lit(key).alias("check_key"),
            F.row_number().over(w).alias("preview_rank"),
            F.col("_record_id").alias("record_id"),
            F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("row_json"),
        ))
    previews = parts[0]
    for p in parts[1:]:
        previews = previews.unionByName(p)
    counts = run.check_counts.filter(F.col("issues_found") > 0)
    return counts.join(previews, "check_key", "inner").select(
        "check_key", "check_name", "issues_found", "preview_rank", "record_id", "row_json"
    )


def csv_ready(df: DataFrame) -> DataFrame:
    """Arrays (not representable in CSV) joined to ', ' text."""
    return df.select(*[
        F.array_join(F.col(f.name), ", ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ])


def export_csv(df: DataFrame, path: str) -> None:
    """R4 sink: details as CSV with a header row."""
    csv_ready(df).write.mode("overwrite").option("header", "true").csv(path)


def json_records(details: DataFrame) -> DataFrame:
    """A check's details as the JSON records ``export_json`` writes (one
    column, ``record``)."""
    return details.select(F.to_json(F.struct(*details.columns), {"ignoreNullFields": "false"}).alias("record"))


def export_json(run: RunResult, path: str) -> None:
    """Every check's details as JSON records under ``path/<check_key>``
    (as many as it has findings), the rows behind grouped findings under
    ``path/<check_key>_members`` and the run summary under ``path/summary`` —
    written by the executors, nothing collected on the driver. Dates are ISO
    text, amounts numbers."""
    for key, check in run.checks.items():
        check.details.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{key}")
        if check.members is not None:
            check.members().write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{key}_members")
    run.summary.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")
    run.check_counts.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/check_counts")


def render_html_report(run: RunResult, generated_at: str, n: int = R.REPORT_PREVIEW_ROWS) -> str:
    """P07 as a page: summary, then per check its issue count and first
    ``n`` rows. Only the bounded preview (at most five times ``n`` rows),
    the five counts and the one-row summary reach the driver."""
    summary = run.summary.first().asDict()
    counts = {r["check_key"]: (r["check_name"], r["issues_found"]) for r in run.check_counts.collect()}
    previews: dict[str, list[dict]] = {}
    for r in report_preview(run, n).orderBy("check_key", "preview_rank").collect():
        previews.setdefault(r["check_key"], []).append(json.loads(r["row_json"]))
    esc = html.escape

    def line(label: str, value) -> str:
        return f"<p><strong>{label}</strong> {esc(str(value))}</p>"

    out = [
        f"<!DOCTYPE html><html><head><title>{R.REPORT_TITLE}</title></head><body>",
        f"<h1>{R.REPORT_TITLE}</h1>",
        line(R.REPORT_GENERATED, generated_at),
        line(R.REPORT_CHECKS, summary["checks_performed"]),
        line(R.REPORT_ISSUES, summary["total_issues_found"]),
        line(R.REPORT_STATUS, summary["status"]),
    ]
    for key in run.checks:
        name, found = counts[key]
        out += [f"<h2>{esc(name)}</h2>", line(R.REPORT_CHECK_ISSUES, found)]
        rows = previews.get(key, [])
        if found and rows:
            cols = list(run.checks[key].base.columns)
            out.append("<table><tr>" + "".join(f"<th>{esc(c)}</th>" for c in cols) + "</tr>")
            for row in rows:
                out.append("<tr>" + "".join(f"<td>{esc(str(row.get(c, '')))}</td>" for c in cols) + "</tr>")
            out.append("</table>")
    out.append("</body></html>")
    return "\n".join(out)


def write_html_report(run: RunResult, path: str, generated_at: str, n: int = R.REPORT_PREVIEW_ROWS) -> None:
    """Write the page as one text file under ``path`` through Spark, so it
    lands on the same (shared) file system as the other outputs."""
    page = render_html_report(run, generated_at, n)
    spark = run.summary.sparkSession
    spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(path)
