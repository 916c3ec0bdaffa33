"""Checks over ``encounters``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import date_lit, days_between, is_false, is_true
from .core import before


def undocumented_condition(as_of: dt.date | str | None = None, days: int = R.UNDOCUMENTED_DAYS) -> Column:
    """Row predicate of C20."""
    return is_false(F.col("documentation_complete")) & before("encounter_date", as_of, days)


def unbilled_condition(as_of: dt.date | str | None = None, days: int = R.UNBILLED_DAYS) -> Column:
    """Row predicate of C21."""
    return is_true(F.col("documentation_complete")) & is_false(F.col("billing_submitted")) & before("encounter_date", as_of, days)


def incomplete_encounters(encounters: DataFrame, as_of: dt.date | str | None = None, days: int = R.UNDOCUMENTED_DAYS,
                          sort: bool = False) -> DataFrame:
    """C20: encounters older than ``days`` days whose documentation is not
    complete (``= FALSE``: a NULL flag is not reported)."""
    out = encounters.filter(undocumented_condition(as_of, days)).select(
        "encounter_id", "patient_id", "provider_id", "encounter_date", "encounter_type",
        "documentation_complete", "billing_submitted",
        days_between(date_lit(as_of), F.col("encounter_date")).alias("days_since_encounter"),
        F.lit(R.ISSUE_INCOMPLETE_DOCUMENTATION).alias("issue_type"),
    )
    return out.orderBy("encounter_date") if sort else out


def documented_not_billed(encounters: DataFrame, as_of: dt.date | str | None = None, days: int = R.UNBILLED_DAYS,
                          sort: bool = False) -> DataFrame:
    """Documented encounters older than ``days`` days not yet billed."""
    out = encounters.filter(unbilled_condition(as_of, days)).select(
        "encounter_id", "patient_id", "provider_id", "encounter_date",
        "documentation_complete", "billing_submitted",
        days_between(date_lit(as_of), F.col("encounter_date")).alias("days_since_encounter"),
        F.lit(R.ISSUE_DOCUMENTED_NOT_BILLED).alias("issue_type"),
    )
    return out.orderBy("encounter_date") if sort else out
