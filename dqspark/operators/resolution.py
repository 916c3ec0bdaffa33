"""The audit log with a history (W1, M4): findings stay as they were written,
what happens to them are events.

An event gives a finding (``audit_id``) a status at a time, with who it is
assigned to and notes. The log's current state, each finding's time line and
the resolution times all come from findings and events; a rerun that writes
the same findings again keeps their history, since events live in a table of
their own and serial ids repeat for the same findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import AUDIT_OPEN
from .numbering import ordered

RESOLVED = "RESOLVED"
_WHEN = ("event_time", "event_id")


def _latest(value: str | Column) -> Column:
    return F.max_by(value, F.struct(*_WHEN))


def current_log(findings: DataFrame, events: DataFrame) -> DataFrame:
    """``findings`` with the status, assignment and notes of their latest event
    (events of one time: the largest ``event_id``). A field that event leaves
    NULL keeps its last value; ``resolved_at`` is the time of the event that
    resolved it, NULL once it is open again. Events of unknown findings are
    ignored. One partially aggregated row per finding meets the log."""
    latest = events.groupBy(F.col("audit_id").alias("_id")).agg(
        _latest("status").alias("_status"), F.max("event_time").alias("_time"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*_WHEN))).alias(f"_{c}") for c in ("assigned_to", "resolution_notes")])
    status = F.coalesce("_status", "status")
    changed = {"status": status, "assigned_to": F.coalesce("_assigned_to", "assigned_to"),
               "resolution_notes": F.coalesce("_resolution_notes", "resolution_notes"),
               "resolved_at": F.when(F.col("_status").isNull(), F.col("resolved_at")).when(status == RESOLVED, F.col("_time"))}
    joined = findings.join(latest, findings["audit_id"] == latest["_id"], "left")
    return joined.select(*[changed[c].alias(c) if c in changed else findings[c] for c in findings.columns])


def status_timeline(findings: DataFrame, events: DataFrame) -> DataFrame:
    """One row per status a finding had: ``audit_id, entry_no, status,
    valid_from, valid_to`` (NULL while it lasts). Entry 1 is its opening.

    Entries are numbered across range partitions in order of finding and time,
    and each meets the next number: no task gathers the events of a finding."""
    opened = findings.select("audit_id", F.lit(AUDIT_OPEN).alias("status"), F.col("check_timestamp").alias("event_time"),
                             F.lit(None).cast("bigint").alias("event_id"))
    known = events.join(findings.select("audit_id"), "audit_id", "left_semi")
    entries = opened.unionByName(known.select("audit_id", "status", "event_time", F.col("event_id").cast("bigint").alias("event_id")))
    # An opening has no event id and comes first among entries of one time.
    placed = ordered(entries, ["audit_id", "event_time", "event_id"], "_n")
    following = placed.select((F.col("_n") - 1).alias("_n"), F.col("audit_id").alias("_id"), F.col("event_time").alias("valid_to"))
    first = placed.groupBy(F.col("audit_id").alias("_first_id")).agg(F.min("_n").alias("_first"))
    spans = placed.join(following, "_n", "left").join(first, F.col("audit_id") == F.col("_first_id"))
    return spans.select("audit_id", (F.col("_n") - F.col("_first") + 1).alias("entry_no"), "status",
                        F.col("event_time").alias("valid_from"),
                        F.when(F.col("_id") == F.col("audit_id"), F.col("valid_to")).alias("valid_to"))


def time_in_status(timeline: DataFrame) -> DataFrame:
    """Per status, how many finished stays there were and their mean hours."""
    hours = F.timestamp_diff("SECOND", F.col("valid_from"), F.col("valid_to")) / 3600.0
    return timeline.filter("valid_to IS NOT NULL").groupBy("status").agg(
        F.count(F.lit(1)).alias("stays"), F.round(F.avg(hours), 2).alias("avg_hours"))
