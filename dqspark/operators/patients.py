"""Checks over ``patient_records``.

Every check takes the reference date ``as_of`` explicitly where the rule
depends on the clock, so a run can be replayed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import (
    age_years,
    all_of,
    any_of,
    as_timestamp,
    date_lit,
    days_between,
    is_true,
    pct,
    ts_lit,
)
from .core import DuplicateGroups, duplicates, incomplete


def _active(df: DataFrame) -> DataFrame:
    return df.filter(is_true(F.col("is_active")))


def _no_contact():
    return F.col("contact_phone").isNull() & F.col("contact_email").isNull()


def _required_checks(fields=R.PATIENT_REQUIRED_FIELDS):
    return [(f, F.col(f).isNull()) for f in fields]


def _completeness_checks():
    return _required_checks() + [(R.CONTACT_INFO_FIELD, _no_contact())]


def incomplete_patient_condition() -> Column:
    """Row predicate of C02 and P01."""
    return is_true(F.col("is_active")) & any_of([c for _, c in _completeness_checks()])


def missing_field_condition() -> Column:
    """Row predicate of R1."""
    return any_of([c for _, c in _required_checks()])


def patient_completeness_summary(patients: DataFrame) -> DataFrame:
    """One row of counts over active patients.

    The percentage counts a record complete when the four required fields are
    present; contact details are counted separately and do not enter it. An
    empty input gives a NULL percentage instead of a division error.
    """
    required_present = all_of([F.col(f).isNotNull() for f in R.PATIENT_REQUIRED_FIELDS])
    return _active(patients).agg(
        F.lit(R.COMPLETENESS_CHECK_NAME).alias("check_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("name").isNull()).alias("missing_name"),
        F.count_if(F.col("date_of_birth").isNull()).alias("missing_dob"),
        F.count_if(F.col("insurance_id").isNull()).alias("missing_insurance"),
        F.count_if(F.col("primary_provider").isNull()).alias("missing_provider"),
        F.count_if(_no_contact()).alias("missing_all_contact"),
        pct(F.count_if(required_present), F.count(F.lit(1))).alias("completeness_percentage"),
    )


def incomplete_patients(patients: DataFrame, sort: bool = False, with_contact_columns: bool = False,
                        with_timestamps: bool = True) -> DataFrame:
    """Active patients missing a required field or all contact details,
    with the list of what is missing; ``sort=True``: newest first (NULL ``created_at`` first,
    as PostgreSQL's DESC)."""
    cols = ["patient_id", "name", "date_of_birth", "insurance_id", "primary_provider"]
    if with_contact_columns:
        cols += ["contact_phone", "contact_email"]
    if with_timestamps:
        cols += ["created_at", "updated_at"]
    out = incomplete(_active(patients), _completeness_checks(), cols)
    if with_timestamps:
        out = out.select(*[c for c in cols if c not in ("created_at", "updated_at")],
                         "missing_fields", "created_at", "updated_at")
        if sort:
            out = out.orderBy(F.col("created_at").desc_nulls_first())
    return out


def invalid_dob_condition(as_of: dt.date | str | None = None, min_date: str = R.MIN_BIRTH_DATE,
                          max_age: int = R.MAX_AGE_YEARS) -> Column:
    """Row predicate of C03 (NULL birth dates are not reported)."""
    today = date_lit(as_of)
    dob = F.col("date_of_birth")
    return (dob > today) | (dob < F.lit(min_date).cast("date")) | (age_years(dob, today) > max_age)


def invalid_phone_condition(digits: int = R.PHONE_DIGITS) -> Column:
    """Row predicate of C04: an active patient's phone without exactly
    ``digits`` digits."""
    phone = F.col("contact_phone")
    n_digits = F.length(F.regexp_replace(phone, R.NON_DIGIT_PATTERN, ""))
    return is_true(F.col("is_active")) & phone.isNotNull() & (n_digits != digits)


def invalid_email_condition(pattern: str = R.EMAIL_PATTERN) -> Column:
    """Row predicate of C05: an active patient's e-mail not matching ``pattern``."""
    email = F.col("contact_email")
    return is_true(F.col("is_active")) & email.isNotNull() & ~email.rlike(pattern)


def invalid_dob(patients: DataFrame, as_of: dt.date | str | None = None, min_date: str = R.MIN_BIRTH_DATE,
                max_age: int = R.MAX_AGE_YEARS, sort: bool = False) -> DataFrame:
    """Birth date in the future, before ``min_date``, or an age above
    ``max_age`` whole years. Applies to all patients, active or not."""
    age = age_years(F.col("date_of_birth"), date_lit(as_of))
    out = patients.filter(invalid_dob_condition(as_of, min_date, max_age)).select(
        "patient_id", "name", "date_of_birth", age.alias("age"),
        F.lit(R.ISSUE_INVALID_DOB).alias("issue_type"),
    )
    return out.orderBy("date_of_birth") if sort else out


def invalid_phone(patients: DataFrame, digits: int = R.PHONE_DIGITS) -> DataFrame:
    """Active patients whose phone does not have exactly ``digits`` digits."""
    return patients.filter(invalid_phone_condition(digits)).select(
        "patient_id", "name", "contact_phone", F.lit(R.ISSUE_INVALID_PHONE).alias("issue_type"),
    )


def invalid_email(patients: DataFrame, pattern: str = R.EMAIL_PATTERN) -> DataFrame:
    """Active patients whose e-mail does not match ``pattern``."""
    return patients.filter(invalid_email_condition(pattern)).select(
        "patient_id", "name", "contact_email", F.lit(R.ISSUE_INVALID_EMAIL).alias("issue_type"),
    )


def duplicate_key_condition() -> Column:
    """Rows that C13 compares: active, with a name and a birth date."""
    return is_true(F.col("is_active")) & F.col("name").isNotNull() & F.col("date_of_birth").isNotNull()


def duplicate_patient_groups(patients: DataFrame) -> DuplicateGroups:
    return duplicates(patients.filter(duplicate_key_condition()), ["name", "date_of_birth"], "patient_id")


def duplicate_patients(patients: DataFrame, sort: bool = False) -> DataFrame:
    """Active patients sharing name and birth date, one row per patient,
    numbered within their group; ``sort=True``: largest groups first."""
    out = duplicate_patient_groups(patients).members().select(
        "name", "date_of_birth", "duplicate_count", "first_id", "member_no", "patient_id",
        F.lit(R.ISSUE_DUPLICATE_PATIENT).alias("issue_type"),
    )
    return out.orderBy(F.col("duplicate_count").desc(), "name", "date_of_birth", "member_no") if sort else out


def stale_patient_condition(as_of: dt.datetime | dt.date | str | None = None, years: int = R.STALE_YEARS) -> Column:
    """Row predicate of C19."""
    cutoff = ts_lit(as_timestamp(as_of)) - F.make_interval(F.lit(years))
    return is_true(F.col("is_active")) & (F.col("updated_at") < cutoff)


def stale_patients(patients: DataFrame, as_of: dt.datetime | dt.date | str | None = None,
                   years: int = R.STALE_YEARS, sort: bool = False) -> DataFrame:
    """Active patients not updated for more than ``years`` years before
    the run timestamp; the day count uses the date part of ``updated_at``."""
    now = as_timestamp(as_of)
    out = patients.filter(stale_patient_condition(now, years)).select(
        "patient_id", "name", "last_visit_date", "updated_at",
        days_between(date_lit(now.date()), F.to_date("updated_at")).alias("days_since_update"),
        F.lit(R.ISSUE_STALE_PATIENT).alias("issue_type"),
    )
    return out.orderBy("updated_at") if sort else out


def missing_field_counts(patients: DataFrame) -> DataFrame:
    """Every patient (no active filter) missing one of the four required
    fields, with the count and the list."""
    out = incomplete(patients, _required_checks(), ["patient_id"])
    return out.select("patient_id", F.size("missing_fields").alias("missing_fields_count"), "missing_fields")
