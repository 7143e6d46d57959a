"""Adapters from the driver's TPC-H-style parquet tables to the portfolio tables.

Each adapter has a Spark form (a lazy DataFrame over the parquet files, so
filters and projections push into the scans) and an equivalent SQL CTE used by
the DuckDB oracle. Both must stay in step.

Mapping (all derived from the given tables, so the work grows with them):

* employers     <- customer (+ nation, region); contact features <- orders
* interactions  <- orders
* vacancies     <- orders left join first ship date per order (lineitem)
* events        <- events (timestamp recency variant)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.session import pin_time_zone

#: Reference date of the test data: orders end on 2001-08-01.
AS_OF = _dt.date(2001, 8, 2)

# --- fixed values: adapter code tables -------------------------------------
SECTOR_OF_SEGMENT = {
    "AUTOMOBILE": "manufacturing",
    "BUILDING": "construction",
    "FURNITURE": "retail",
    "HOUSEHOLD": "healthcare",
    "MACHINERY": "tech",
}
TYPE_OF_PRIORITY = {
    "1-URGENT": "call",
    "2-HIGH": "email",
    "3-MEDIUM": "meeting",
    "4-NOT SPECIFIED": "event",
    "5-LOW": "linkedin",
}
OUTCOME_OF_STATUS = {"F": "positive", "O": "neutral", "P": "no_response"}
# account-balance bands: (upper bound, size)
SIZE_BANDS = [(1500.0, "micro"), (4500.0, "small"), (7500.0, "medium")]
SIZE_ABOVE = "large"
N_CONSULTANTS = 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_time_zone(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_expr(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _size_expr(balance):
    expr = None
    for bound, name in SIZE_BANDS:
        cond = balance < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SIZE_ABOVE))


def _status_expr(key):
    m = key % 5
    return F.when(m < 3, F.lit("Active")).when(m == 3, F.lit("Inactive")).otherwise(F.lit("Prospect"))


def employers_raw(spark: SparkSession, sf_dir: str, with_revenue: bool = True, numeric_key: bool = False) -> DataFrame:
    """Employer master table without contact features (``numeric_key``: keep the bigint key)."""
    cust = read_table(spark, sf_dir, "customer")
    geo = (read_table(spark, sf_dir, "nation")
           .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
           .select("n_nationkey", F.col("r_name").alias("region")))
    cols = [
        (F.col("c_custkey") if numeric_key else F.col("c_custkey").cast("string")).alias("employer_id"),
        F.col("c_name").alias("company_name"),
        _size_expr(F.col("c_acctbal")).alias("company_size"),
        _map_expr(F.col("c_mktsegment"), SECTOR_OF_SEGMENT).alias("sector"),
        F.col("region"),
        _status_expr(F.col("c_custkey")).alias("status"),
    ]
    if with_revenue:
        cols.append(F.col("c_acctbal").alias("revenue_potential"))
    return cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(*cols)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact history: one interaction per order."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("interaction_id"),
        F.col("o_custkey").cast("string").alias("employer_id"),
        F.to_date("o_orderdate").alias("interaction_date"),
        _map_expr(F.col("o_orderpriority"), TYPE_OF_PRIORITY).alias("interaction_type"),
        _map_expr(F.col("o_orderstatus"), OUTCOME_OF_STATUS).alias("outcome"),
        (F.col("o_orderstatus") == "O").alias("follow_up_required"),
        F.format_string("CONS%03d", F.col("o_custkey") % N_CONSULTANTS).alias("consultant_id"),
    )


def employers(spark: SparkSession, sf_dir: str, as_of=AS_OF, with_revenue: bool = True) -> DataFrame:
    """Employers enriched with last contact and 12-month frequency (AGG1-2, JOIN1-2, FIL1)."""
    from accountlens.operators.features import contact_features, enrich_employers
    # aggregate and join on the bigint key (cheaper to hash than its text), cast once at the end
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("employer_id"), F.to_date("o_orderdate").alias("interaction_date"))
    feats = contact_features(orders, as_of=as_of)
    out = enrich_employers(employers_raw(spark, sf_dir, with_revenue, numeric_key=True), feats)
    return out.withColumn("employer_id", F.col("employer_id").cast("string"))


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vacancies: open = order date, filled = first ship date, status from order status."""
    first_ship = (read_table(spark, sf_dir, "lineitem")
                  .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship")))
    o = read_table(spark, sf_dir, "orders")
    return (o.join(first_ship, o["o_orderkey"] == first_ship["l_orderkey"], "left")
            .select(F.col("o_orderkey").cast("string").alias("vacancy_id"),
                    F.col("o_custkey").cast("string").alias("employer_id"),
                    F.to_date("o_orderdate").alias("open_date"),
                    F.to_date("first_ship").alias("filled_date"),
                    F.when(F.col("o_orderstatus") == "F", "Filled")
                    .when(F.col("o_orderstatus") == "O", "Open")
                    .otherwise("In Progress").alias("status")))


def event_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamped contacts (non-midnight) from ``events``: one row per user."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").cast("string").alias("employer_id")).agg(
        F.max("ts").alias("last_contact_ts"))


# ---------------------------------------------------------------------------
# SQL (DuckDB) forms of the same adapters
# ---------------------------------------------------------------------------

def _sql_case(col: str, mapping: dict, default="NULL") -> str:
    parts = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {parts} ELSE {default} END"


def _sql_size(col: str) -> str:
    parts = " ".join(f"WHEN {col} < {b} THEN '{n}'" for b, n in SIZE_BANDS)
    return f"CASE {parts} ELSE '{SIZE_ABOVE}' END"


def sql_date(d) -> str:
    return f"DATE '{d.isoformat()}'"


def sql_ctes(as_of=AS_OF, with_revenue: bool = True) -> str:
    """WITH-clause bodies defining employers_raw, interactions, contact, employers, vacancies."""
    cutoff = as_of - _dt.timedelta(days=365)
    revenue = ", c.c_acctbal AS revenue_potential" if with_revenue else ""
    return f"""
employers_raw AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS employer_id,
         c.c_name AS company_name,
         {_sql_size('c.c_acctbal')} AS company_size,
         {_sql_case('c.c_mktsegment', SECTOR_OF_SEGMENT)} AS sector,
         r.r_name AS region,
         CASE WHEN c.c_custkey % 5 < 3 THEN 'Active' WHEN c.c_custkey % 5 = 3 THEN 'Inactive'
              ELSE 'Prospect' END AS status{revenue}
  FROM customer c
  LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n LEFT JOIN region r
             ON n.n_regionkey = r.r_regionkey) r ON c.c_nationkey = r.n_nationkey
),
interactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS interaction_id,
         CAST(o_custkey AS VARCHAR) AS employer_id,
         CAST(o_orderdate AS DATE) AS interaction_date,
         {_sql_case('o_orderpriority', TYPE_OF_PRIORITY)} AS interaction_type,
         {_sql_case('o_orderstatus', OUTCOME_OF_STATUS)} AS outcome,
         o_orderstatus = 'O' AS follow_up_required,
         'CONS' || lpad(CAST(o_custkey % {N_CONSULTANTS} AS VARCHAR), 3, '0') AS consultant_id
  FROM orders
),
contact AS (
  SELECT employer_id, max(interaction_date) AS last_contact_date,
         CAST(count(*) FILTER (WHERE interaction_date >= {sql_date(cutoff)}) AS BIGINT) AS frequency_12m
  FROM interactions GROUP BY employer_id
),
employers AS (
  SELECT e.*, c.last_contact_date, CAST(coalesce(c.frequency_12m, 0) AS BIGINT) AS frequency_12m
  FROM employers_raw e LEFT JOIN contact c ON e.employer_id = c.employer_id
),
vacancies AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS vacancy_id, CAST(o.o_custkey AS VARCHAR) AS employer_id,
         CAST(o.o_orderdate AS DATE) AS open_date, CAST(s.first_ship AS DATE) AS filled_date,
         CASE o.o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'In Progress' END AS status
  FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) s
       ON o.o_orderkey = s.l_orderkey
)"""


# ---------------------------------------------------------------------------
# Injected faults for the contract / quality queries (same rules as the SQL forms)
# ---------------------------------------------------------------------------

def dirty_employers(emp: DataFrame) -> DataFrame:
    """Nulls, duplicates, unknown values and future dates keyed on the customer key; all rows kept."""
    k = F.col("employer_id").cast("long")
    return emp.select(
        F.when(k % 97 == 1, F.lit(None).cast("string")).when(k % 89 == 2, (k - 1).cast("string"))
        .otherwise(F.col("employer_id")).alias("employer_id"),
        "company_name",
        F.when(k % 83 == 3, F.lit("giant")).otherwise(F.col("company_size")).alias("company_size"),
        F.when(k % 67 == 7, F.lit("mining")).otherwise(F.col("sector")).alias("sector"),
        "region",
        F.when(k % 79 == 4, F.lit("Unknown")).otherwise(F.col("status")).alias("status"),
        "revenue_potential",
        F.when(k % 71 == 6, F.lit(None).cast("date")).when(k % 73 == 5, F.add_months("last_contact_date", 120))
        .otherwise(F.col("last_contact_date")).alias("last_contact_date"),
        "frequency_12m",
    )


def dirty_interactions(inter: DataFrame) -> DataFrame:
    k = F.col("interaction_id").cast("long")
    return inter.select(
        F.when(k % 997 == 1, F.lit(None).cast("string")).when(k % 991 == 2, (k - 1).cast("string"))
        .otherwise(F.col("interaction_id")).alias("interaction_id"),
        F.when(k % 971 == 5, F.lit(None).cast("string")).when(k % 953 == 8, F.concat(F.lit("X"), F.col("employer_id")))
        .otherwise(F.col("employer_id")).alias("employer_id"),
        F.when(k % 967 == 6, F.lit(None).cast("date")).when(k % 961 == 7, F.add_months("interaction_date", 240))
        .otherwise(F.col("interaction_date")).alias("interaction_date"),
        F.when(k % 983 == 3, F.lit("carrier_pigeon")).otherwise(F.col("interaction_type")).alias("interaction_type"),
        F.when(k % 977 == 4, F.lit("maybe")).otherwise(F.col("outcome")).alias("outcome"),
        "follow_up_required", "consultant_id",
    )
