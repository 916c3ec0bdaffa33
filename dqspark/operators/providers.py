"""Checks over ``providers``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import any_of, date_lit, days_between, is_true
from .core import incomplete


def expired_license_condition(as_of: dt.date | str | None = None) -> Column:
    """Row predicate of C11 and P05."""
    return (F.col("license_expiry_date") < date_lit(as_of)) & is_true(F.col("is_active"))


def incomplete_provider_condition() -> Column:
    """Row predicate of C12."""
    return is_true(F.col("is_active")) & any_of([F.col(f).isNull() for f in R.PROVIDER_REQUIRED_FIELDS])


def expired_licenses(providers: DataFrame, as_of: dt.date | str | None = None, with_issue_type: bool = True,
                     sort: bool = False) -> DataFrame:
    """C11: active providers whose licence expired before ``as_of``."""
    today = date_lit(as_of)
    cols = [
        "provider_id", "provider_name", "license_number", "license_state", "license_expiry_date",
        days_between(today, F.col("license_expiry_date")).alias("days_expired"),
    ]
    if with_issue_type:
        cols.append(F.lit(R.ISSUE_EXPIRED_LICENSE).alias("issue_type"))
    out = providers.filter(expired_license_condition(as_of)).select(*cols)
    return out.orderBy("license_expiry_date") if sort else out


def incomplete_providers(providers: DataFrame) -> DataFrame:
    """Active providers missing NPI, licence, specialty or e-mail."""
    checks = [(f, F.col(f).isNull()) for f in R.PROVIDER_REQUIRED_FIELDS]
    active = providers.filter(is_true(F.col("is_active")))
    return incomplete(active, checks, ["provider_id", "provider_name", "npi_number", "license_number", "specialty"])
