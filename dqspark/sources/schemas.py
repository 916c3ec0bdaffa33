"""Declared table schemas for the healthcare data model.

Each table is described once by ``ColumnSpec`` entries; the Spark
``StructType``, the VARCHAR length limits (K6), the NOT NULL columns (K2),
the decimal columns (K7) and the DDL defaults (W2) are all read off that
description, so the constraint checks are driven by metadata rather than
hand-listed per table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    max_length: int | None = None   # VARCHAR(n)
    nullable: bool = True
    default: str | None = None      # "now", "today", or a SQL literal


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: str
    foreign_keys: tuple[tuple[str, str, str], ...] = ()   # (column, parent table, parent column)
    unique: tuple[str, ...] = ()
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, c.nullable) for c in self.columns]
        )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name}")

    @property
    def max_lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable and c.name != self.primary_key]

    @property
    def decimal_columns(self) -> list[str]:
        return [c.name for c in self.columns if isinstance(c.dtype, T.DecimalType)]


S = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()
BOOL = T.BooleanType()
MONEY = T.DecimalType(10, 2)
INT = T.IntegerType()
LONG = T.LongType()


def _v(name, n=None, nullable=True):
    return ColumnSpec(name, S, n, nullable)


# Claim status, audit severity and audit status domains of the
# reference schema.
CLAIM_STATUSES = ("SUBMITTED", "PENDING", "PROCESSED", "DENIED", "PAID")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
AUDIT_STATUSES = ("OPEN", "IN_PROGRESS", "RESOLVED", "ACKNOWLEDGED")


PATIENT_RECORDS = TableSpec(
    "patient_records",
    (
        _v("patient_id", 50, nullable=False),
        _v("name", 255),
        ColumnSpec("date_of_birth", DATE),
        _v("gender", 10),
        _v("insurance_id", 100),
        _v("insurance_provider", 100),
        _v("primary_provider", 255),
        _v("contact_phone", 20),
        _v("contact_email", 255),
        _v("address_line1", 255),
        _v("address_city", 100),
        _v("address_state", 2),
        _v("address_zip", 10),
        _v("emergency_contact_name", 255),
        _v("emergency_contact_phone", 20),
        ColumnSpec("created_at", TS, default="now"),
        ColumnSpec("updated_at", TS, default="now"),
        ColumnSpec("last_visit_date", DATE),
        ColumnSpec("is_active", BOOL, default="TRUE"),
    ),
    primary_key="patient_id",
)

PROVIDERS = TableSpec(
    "providers",
    (
        _v("provider_id", 50, nullable=False),
        _v("provider_name", 255, nullable=False),
        _v("specialty", 100),
        _v("npi_number", 10),
        _v("license_number", 50),
        _v("license_state", 2),
        ColumnSpec("license_expiry_date", DATE),
        _v("contact_email", 255),
        _v("contact_phone", 20),
        _v("practice_name", 255),
        ColumnSpec("is_active", BOOL, default="TRUE"),
        ColumnSpec("created_at", TS, default="now"),
    ),
    primary_key="provider_id",
    unique=("npi_number",),
)

CLAIMS = TableSpec(
    "claims",
    (
        _v("claim_id", 50, nullable=False),
        _v("patient_id", 50),
        _v("provider_id", 50),
        ColumnSpec("claim_total_amount", MONEY),
        ColumnSpec("service_date", DATE, nullable=False),
        ColumnSpec("submission_date", DATE, nullable=False),
        ColumnSpec("processing_date", DATE),
        _v("status", 20),
        _v("denial_reason"),
        _v("procedure_code", 10),
        _v("diagnosis_code", 10),
        ColumnSpec("insurance_paid_amount", MONEY),
        ColumnSpec("patient_responsibility", MONEY),
        ColumnSpec("adjustment_amount", MONEY, default="0"),
        ColumnSpec("created_at", TS, default="now"),
        ColumnSpec("updated_at", TS, default="now"),
    ),
    primary_key="claim_id",
    foreign_keys=(
        ("patient_id", "patient_records", "patient_id"),
        ("provider_id", "providers", "provider_id"),
    ),
    domains=(("status", CLAIM_STATUSES),),
)

CLAIMS_LINE_ITEMS = TableSpec(
    "claims_line_items",
    (
        ColumnSpec("line_item_id", LONG, nullable=False),
        _v("claim_id", 50),
        _v("procedure_code", 10, nullable=False),
        _v("description"),
        ColumnSpec("quantity", INT, default="1"),
        ColumnSpec("unit_price", MONEY),
        ColumnSpec("line_item_amount", MONEY),
        _v("modifier", 10),
        ColumnSpec("service_date", DATE),
    ),
    primary_key="line_item_id",
    foreign_keys=(("claim_id", "claims", "claim_id"),),
)

ENCOUNTERS = TableSpec(
    "encounters",
    (
        _v("encounter_id", 50, nullable=False),
        _v("patient_id", 50),
        _v("provider_id", 50),
        ColumnSpec("encounter_date", DATE, nullable=False),
        _v("encounter_type", 50),
        _v("chief_complaint"),
        ColumnSpec("diagnosis_codes", T.ArrayType(S)),
        ColumnSpec("procedure_codes", T.ArrayType(S)),
        ColumnSpec("documentation_complete", BOOL, default="FALSE"),
        ColumnSpec("billing_submitted", BOOL, default="FALSE"),
        ColumnSpec("created_at", TS, default="now"),
        ColumnSpec("updated_at", TS, default="now"),
    ),
    primary_key="encounter_id",
    foreign_keys=(
        ("patient_id", "patient_records", "patient_id"),
        ("provider_id", "providers", "provider_id"),
    ),
)

QUALITY_AUDIT_LOG = TableSpec(
    "quality_audit_log",
    (
        ColumnSpec("audit_id", LONG, nullable=False),
        ColumnSpec("check_timestamp", TS, default="now"),
        _v("check_type", 100),
        _v("table_name", 100),
        _v("record_id", 50),
        _v("issue_type", 100),
        _v("issue_description"),
        _v("severity", 20),
        ColumnSpec("status", S, 20, default="'OPEN'"),
        _v("assigned_to", 100),
        _v("resolution_notes"),
        ColumnSpec("resolved_at", TS),
    ),
    primary_key="audit_id",
    domains=(("severity", SEVERITIES), ("status", AUDIT_STATUSES)),
)

QUALITY_METRICS = TableSpec(
    "quality_metrics",
    (
        ColumnSpec("metric_id", LONG, nullable=False),
        ColumnSpec("metric_date", DATE, default="today"),
        _v("metric_name", 100),
        ColumnSpec("metric_value", MONEY),
        ColumnSpec("target_value", MONEY),
        _v("category", 50),
        _v("notes"),
        ColumnSpec("created_at", TS, default="now"),
    ),
    primary_key="metric_id",
)

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        PATIENT_RECORDS,
        PROVIDERS,
        CLAIMS,
        CLAIMS_LINE_ITEMS,
        ENCOUNTERS,
        QUALITY_AUDIT_LOG,
        QUALITY_METRICS,
    )
}
