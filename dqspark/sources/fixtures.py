"""Healthcare test tables derived from the driver's TPC-H-style tables.

The reference ships no data, so the check inputs are derived, with the
DataFrame API, from ``customer``, ``supplier``, ``orders``, ``lineitem`` and
``events``. Defects (NULLs, malformed values, orphans, repeats, off-by-a-cent
totals, a hot patient) are injected by fixed arithmetic rules on the source
keys so that an independent SQL derivation yields the same rows. Every
derived table grows linearly with its source table.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import read_source

# The reference date every fixture rule is anchored to.
FIXTURE_AS_OF = "2024-02-01"
SERVICE_DATE_SHIFT_DAYS = 8210

# Declared schemas of the source tables (the test data's layout), so reading
# them needs no schema-inference job.
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}



def _anchor():
    return F.lit(FIXTURE_AS_OF).cast("date")


def patient_records(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    k2 = F.when(k % 23 == 1, k - 1).otherwise(k)
    base = customer.select(k.alias("k"), k2.alias("k2"))
    k, k2 = F.col("k"), F.col("k2")
    dob = (
        F.when(k2 % 19 == 0, F.lit(None))
        .when(k2 % 29 == 0, F.lit("2030-01-01").cast("date"))
        .when(k2 % 31 == 0, F.lit("1890-05-05").cast("date"))
        .when(k2 % 37 == 0, F.lit("1901-06-06").cast("date"))
        .otherwise(F.date_add(F.lit("1930-01-01").cast("date"), ((k2 * 37) % 25000).cast("int")))
    )
    phone = (
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 9 == 0, F.lit("555-0"))
        .when(k % 43 == 0, F.lit("+1 (555) 123-4567 ext 89"))
        .otherwise(F.concat(F.lit("(555) 123-"), (1000 + k % 9000).cast("string")))
    )
    email = (
        F.when(k % 5 == 0, F.lit(None))
        .when(k % 8 == 0, F.concat(F.lit("user"), k.cast("string"), F.lit(".example.com")))
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")))
    )
    return base.select(
        F.concat(F.lit("P"), k.cast("string")).alias("patient_id"),
        F.when(k2 % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("Name "), k2.cast("string"))).alias("name"),
        dob.alias("date_of_birth"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("I"), k.cast("string"))).alias("insurance_id"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("D"), (k % 10).cast("string"))).alias("primary_provider"),
        phone.alias("contact_phone"),
        email.alias("contact_email"),
        F.date_sub(_anchor(), ((k * 17) % 2000 + 1000).cast("int")).cast("timestamp_ntz").alias("created_at"),
        F.date_sub(_anchor(), ((k * 13) % 1500).cast("int")).cast("timestamp_ntz").alias("updated_at"),
        F.date_sub(_anchor(), ((k * 11) % 900).cast("int")).alias("last_visit_date"),
        F.when(k % 41 == 0, F.lit(None).cast("boolean")).otherwise(k % 10 != 3).alias("is_active"),
    )


def providers(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("D"), s.cast("string")).alias("provider_id"),
        F.when(s % 10 == 9, F.lit(None)).otherwise(F.col("s_name")).alias("provider_name"),
        F.when(s % 4 == 3, F.lit(None)).otherwise(F.lit("Cardiology")).alias("specialty"),
        F.when(s % 5 == 1, F.lit(None))
        .when(s % 8 == 0, F.lit("1000000000"))
        .otherwise((1000000000 + s).cast("string"))
        .alias("npi_number"),
        F.when(s % 7 == 2, F.lit(None)).otherwise(F.concat(F.lit("L"), s.cast("string"))).alias("license_number"),
        F.lit("CA").alias("license_state"),
        F.date_add(_anchor(), ((s * 97) % 1000 - 300).cast("int")).alias("license_expiry_date"),
        F.when(s % 9 == 4, F.lit(None))
        .otherwise(F.concat(F.lit("d"), s.cast("string"), F.lit("@example.com")))
        .alias("contact_email"),
        (s % 6 != 5).alias("is_active"),
    )


def _line_cents():
    """A line's amount in whole cents (below 12,000.00).

    The rule is ``ROUND(l_extendedprice * 100)``. For a non-negative double
    y below 2**52, HALF_UP rounding of its shortest decimal form (Spark's
    ROUND, which builds a BigDecimal per row) equals ``floor(y + 0.5)``:
    a shortest form ending in .5 means y is exactly N.5, and y + 0.5 cannot
    round up because y's distance to N.5 is a multiple of its own ulp.
    Prices are non-negative, so the cheap form is used; the SQL oracle keeps
    ROUND and every claims query compares the amounts.
    """
    return F.floor(F.col("l_extendedprice") * 100 + 0.5) % 1200000


def _orphan_line():
    """Lines attached to the claim id 'C-missing', which no claim has."""
    return F.col("l_partkey") % 83 == 0


def claims_line_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.when(_orphan_line(), F.lit("C-missing"))
        .otherwise(F.concat(F.lit("C"), F.col("l_orderkey").cast("string")))
        .alias("claim_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_item_id"),
        (_line_cents().cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("line_item_amount"),
    )


def order_line_totals(lineitem: DataFrame) -> DataFrame:
    """Sum of line amounts per order, for the claim totals.

    Same values as summing ``claims_line_items.line_item_amount`` per claim
    id and joining on ``'C' || o_orderkey``: the 'C-missing' lines never
    match a claim, so they are dropped first; the rest are keyed by the
    numeric order key (no per-line string building) and summed as integer
    cents (an order has at most seven lines below 12,000.00 each), then
    turned back into an exact DECIMAL.
    """
    return (
        lineitem.filter(~_orphan_line())
        .groupBy(F.col("l_orderkey").alias("lt_orderkey"))
        .agg(F.sum(_line_cents()).alias("lt_cents"))
        .select("lt_orderkey", (F.col("lt_cents").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).alias("lt"))
    )


def claims(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    # Every 61st order is submitted twice, the second time under the claim id
    # suffixed '-dup': one scan of orders, the copy made by an explode.
    suffixes = F.when(F.col("o_orderkey") % 61 == 0, F.array(F.lit(""), F.lit("-dup"))).otherwise(F.array(F.lit("")))
    o = orders.select(
        F.col("o_orderkey").alias("k"),
        F.explode(suffixes).alias("_suffix"),
        "o_custkey",
        "o_orderdate",
    ).select(
        "k",
        F.concat(F.lit("C"), F.col("k").cast("string"), F.col("_suffix")).alias("cid"),
        "o_custkey",
        "o_orderdate",
    )
    # Line totals are aggregated per order before the join.
    lt = order_line_totals(lineitem)
    x = o.join(lt, o["k"] == lt["lt_orderkey"], "left")
    k = F.col("k")
    extra = (
        F.when(k % 37 == 0, F.lit(Decimal("150.25")))
        .when(k % 43 == 0, F.lit(Decimal("2500")))
        .when(k % 47 == 0, F.lit(Decimal("0.01")))
        .otherwise(F.lit(Decimal("0")))
    )
    total = (
        F.when(k % 53 == 0, F.lit(None))
        .when(k % 59 == 0, F.lit(Decimal("0")))
        .otherwise(F.coalesce(F.col("lt"), F.lit(Decimal("500"))) + extra)
        .cast("decimal(10,2)")
    )
    service = F.date_add(F.to_date("o_orderdate"), SERVICE_DATE_SHIFT_DAYS)
    submission = F.date_add(service, F.when(k % 31 == 0, F.lit(-2)).otherwise((k % 10).cast("int")))
    status = (
        F.when(k % 71 == 0, F.lit("VOID"))
        .when(k % 79 == 0, F.lit(None))
        .when(k % 5 == 0, F.lit("SUBMITTED"))
        .when(k % 5 == 1, F.lit("PENDING"))
        .when(k % 5 == 2, F.lit("PROCESSED"))
        .when(k % 5 == 3, F.lit("DENIED"))
        .otherwise(F.lit("PAID"))
    )
    x = x.select(
        "k",
        F.col("cid").alias("claim_id"),
        F.when(k % 101 == 0, F.lit(None))
        .when(k % 97 == 0, F.concat(F.lit("P-missing-"), k.cast("string")))
        .when(k % 3 == 1, F.lit("P7"))
        .otherwise(F.concat(F.lit("P"), F.col("o_custkey").cast("string")))
        .alias("patient_id"),
        F.when(k % 89 == 0, F.lit("D-missing"))
        .otherwise(F.concat(F.lit("D"), (k % 10).cast("string")))
        .alias("provider_id"),
        total.alias("claim_total_amount"),
        service.alias("service_date"),
        submission.alias("submission_date"),
        status.alias("status"),
    )
    return x.select(
        "claim_id",
        "patient_id",
        "provider_id",
        "claim_total_amount",
        "service_date",
        "submission_date",
        F.when(F.col("status").isin("SUBMITTED", "PENDING"), F.lit(None).cast("date"))
        .when(k % 33 == 0, F.date_sub("submission_date", 3))
        .otherwise(F.date_add("submission_date", 5))
        .alias("processing_date"),
        "status",
        (F.col("claim_total_amount") - 20).cast("decimal(10,2)").alias("insurance_paid_amount"),
        F.lit(Decimal("20")).cast("decimal(10,2)").alias("patient_responsibility"),
        F.when(k % 6 == 0, F.lit(None))
        .when(k % 23 == 0, F.lit(Decimal("5")))
        .otherwise(F.lit(Decimal("0")))
        .cast("decimal(10,2)")
        .alias("adjustment_amount"),
    )


def encounters(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return events.select(
        F.concat(F.lit("E"), e.cast("string")).alias("encounter_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("patient_id"),
        F.concat(F.lit("D"), (e % 10).cast("string")).alias("provider_id"),
        F.to_date("ts").alias("encounter_date"),
        F.col("event_type").alias("encounter_type"),
        F.split(F.lit("E11,I10"), ",").alias("diagnosis_codes"),
        (e % 3 != 0).alias("documentation_complete"),
        (e % 4 != 0).alias("billing_submitted"),
    )


def quality_audit_log(events: DataFrame) -> DataFrame:
    e, et = F.col("event_id"), F.col("event_type")
    return events.select(
        e.alias("audit_id"),
        F.col("ts").cast("timestamp_ntz").alias("check_timestamp"),
        F.when(et == "view", F.lit("completeness_check"))
        .when(et == "error", F.lit("temporal_check"))
        .otherwise(F.lit("discrepancy_check"))
        .alias("check_type"),
        F.when(et == "view", F.lit("patient_records")).otherwise(F.lit("claims")).alias("table_name"),
        F.concat(F.lit("R"), F.col("user_id").cast("string")).alias("record_id"),
        et.alias("issue_type"),
        F.when(e % 61 == 0, F.lit("SEVERE"))
        .when(e % 4 == 0, F.lit("LOW"))
        .when(e % 4 == 1, F.lit("MEDIUM"))
        .when(e % 4 == 2, F.lit("HIGH"))
        .otherwise(F.lit("CRITICAL"))
        .alias("severity"),
        F.when(e % 3 == 0, F.lit("RESOLVED"))
        .when(e % 3 == 1, F.lit("OPEN"))
        .otherwise(F.lit("ACKNOWLEDGED"))
        .alias("status"),
        F.when(e % 3 == 0, F.timestamp_add("HOUR", e % 72, F.col("ts").cast("timestamp_ntz"))).alias("resolved_at"),
    )


def raw_claims(orders: DataFrame) -> DataFrame:
    """Claims as text, as they arrive: some values fit no declared type, some
    ids are missing or come twice."""
    k = F.col("k")
    again = F.when(F.col("o_orderkey") % 67 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = orders.select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate", F.explode(again).alias("_copy"))
    service = F.date_add(F.to_date("o_orderdate"), SERVICE_DATE_SHIFT_DAYS)
    return o.select(
        F.when(k % 211 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("claim_id"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
        F.concat(F.lit("D"), (k % 10).cast("string")).alias("provider_id"),
        F.when(k % 113 == 0, F.lit("123456789.00")).when(k % 127 == 0, F.lit("n/a")).when(k % 131 == 0, F.lit("12.345"))
        .otherwise(F.concat((k % 90000).cast("string"), F.lit(".50"))).alias("claim_total_amount"),
        F.when(k % 137 == 0, F.lit("2024-02-30")).when(k % 139 == 0, F.lit(None)).otherwise(service.cast("string")).alias("service_date"),
        F.date_add(service, (k % 10).cast("int")).cast("string").alias("submission_date"),
        F.when(k % 149 == 0, F.lit("VOID")).otherwise(F.lit("PENDING")).alias("status"),
        F.when(k % 151 == 0, F.concat(F.lit("PROCEDURE-"), k.cast("string")))
        .otherwise(F.concat(F.lit("PC"), (k % 1000).cast("string"))).alias("procedure_code"),
    )


def raw_encounters(events: DataFrame) -> DataFrame:
    """Encounters as text, as they arrive."""
    e = F.col("e")
    again = F.when(F.col("event_id") % 71 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.select(F.col("event_id").alias("e"), "user_id", "ts", "event_type", F.explode(again).alias("_copy"))
    return rows.select(
        F.concat(F.lit("E"), e.cast("string")).alias("encounter_id"),
        F.when(e % 53 == 0, F.lit("P-none")).otherwise(F.concat(F.lit("P"), F.col("user_id").cast("string"))).alias("patient_id"),
        F.when(e % 59 == 0, F.lit("D-none")).otherwise(F.concat(F.lit("D"), (1 + e % 9).cast("string"))).alias("provider_id"),
        F.when(e % 61 == 0, F.lit(None)).otherwise(F.to_date("ts").cast("string")).alias("encounter_date"),
        F.when(e % 67 == 0, F.repeat(F.lit("visit "), F.lit(12))).otherwise(F.col("event_type")).alias("encounter_type"),
    )


def raw_audit_log(events: DataFrame) -> DataFrame:
    """Audit rows as another tool hands them over, with a status of its own."""
    e = F.col("event_id")
    return events.select(
        e.cast("string").alias("audit_id"),
        F.when(e % 2 == 0, F.lit("LOW")).otherwise(F.lit("HIGH")).alias("severity"),
        F.when(e % 73 == 0, F.lit("CLOSED")).otherwise(F.lit("OPEN")).alias("status"),
    )


def audit_events(events: DataFrame) -> DataFrame:
    """What happened to the findings of ``quality_audit_log``."""
    e, ts = F.col("event_id"), F.col("ts").cast("timestamp_ntz")

    def entry(no: int, cond, status: str, hours, who=None, notes=None):
        return F.when(cond, F.struct(
            (e * 10 + no).alias("event_id"), F.lit(status).alias("status"), F.timestamp_add("HOUR", hours, ts).alias("event_time"),
            (who if who is not None else F.lit(None).cast("string")).alias("assigned_to"), F.lit(notes).cast("string").alias("resolution_notes")))

    entries = F.array_compact(F.array(
        entry(1, e % 3 == 0, "IN_PROGRESS", F.lit(1), F.concat(F.lit("A"), (e % 7).cast("string"))),
        entry(2, e % 3 == 0, "RESOLVED", 2 + e % 72, notes="checked"),
        entry(3, e % 15 == 0, "OPEN", F.lit(100), notes="seen again"),
        entry(4, e % 5 == 1, "ACKNOWLEDGED", F.lit(3)),
        entry(5, e % 25 == 1, "RESOLVED", F.lit(3))))
    return events.select(e.alias("audit_id"), F.explode(entries).alias("x")).select("audit_id", "x.*")


class HealthcareTables:
    """Lazily derived tables for one test-data directory.

    Each table's logical plan is built once per instance (no data is
    cached; Catalyst still prunes every use to the source columns it needs),
    so a query using a table in several branches pays for building its plan
    once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _src(self, name: str) -> DataFrame:
        return read_source(self.spark, self.sf_dir, name, SOURCE_SCHEMAS.get(name))

    @cached_property
    def patient_records(self) -> DataFrame:
        return patient_records(self._src("customer"))

    @cached_property
    def providers(self) -> DataFrame:
        return providers(self._src("supplier"))

    @cached_property
    def claims_line_items(self) -> DataFrame:
        return claims_line_items(self._src("lineitem"))

    @cached_property
    def claims(self) -> DataFrame:
        return claims(self._src("orders"), self._src("lineitem"))

    @cached_property
    def encounters(self) -> DataFrame:
        return encounters(self._src("events"))

    @cached_property
    def quality_audit_log(self) -> DataFrame:
        return quality_audit_log(self._src("events"))

    @cached_property
    def audit_events(self) -> DataFrame:
        return audit_events(self._src("events"))

    @cached_property
    def raw_claims(self) -> DataFrame:
        return raw_claims(self._src("orders"))

    @cached_property
    def raw_encounters(self) -> DataFrame:
        return raw_encounters(self._src("events"))

    @cached_property
    def raw_audit_log(self) -> DataFrame:
        return raw_audit_log(self._src("events"))

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "patient_records": self.patient_records,
            "providers": self.providers,
            "claims": self.claims,
            "claims_line_items": self.claims_line_items,
            "encounters": self.encounters,
            "quality_audit_log": self.quality_audit_log,
        }


def load_fixtures(spark: SparkSession, sf_dir: str) -> HealthcareTables:
    """The derived tables of ``sf_dir``, built once per session and folder,
    as a user loads tables once and runs every check over them. Only the
    lazy plans are shared: no data is cached, and every action re-reads the
    Parquet sources."""
    registry = spark.__dict__.setdefault("_dqspark_fixture_tables", {})
    tables = registry.get(sf_dir)
    if tables is None:
        tables = registry[sf_dir] = HealthcareTables(spark, sf_dir)
    return tables
