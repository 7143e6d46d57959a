"""Registered queries: one per operator of the inventory, each over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where the semantics are
SQL-expressible, ``ORACLE[name]`` holds an equivalent DuckDB query over the
same tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.operators import contracts as con
from accountlens.operators import features as fe
from accountlens.operators import measures as ms
from accountlens.operators import quality as dq
from accountlens.operators import retention as rt
from accountlens.operators import segmentation as seg
from accountlens.operators import star
from accountlens.operators.calendar import date_dimension, monthly_counts, previous_month
from accountlens.operators.privacy import Pseudonymizer, redact_column
from accountlens.operators.profiles import segment_profile_report, segment_profiles
from accountlens.functions.expressions import in_months_window, safe_divide, whole_days_since
from accountlens.plans import sqlparts as S
from accountlens.session import materialize, scratch_path
from accountlens.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = td.AS_OF
EVENTS_AS_OF = _dt.date(2024, 2, 1)
FIXED_SALT = "catalog-fixed-salt"
FIXED_STAMP = "2001-08-02T00:00:00"


def q(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _emp(spark, sf, **kw):
    return td.employers(spark, sf, **kw)


def _inter(spark, sf):
    return td.interactions(spark, sf)


def _fixed_segmented(spark, sf) -> DataFrame:
    """SEG1-6 + SEG8-10 with cluster = employer key % 4 (oracle-checkable stand-in for K-Means)."""
    emp = _emp(spark, sf).withColumn("cluster", (F.col("employer_id").cast("long") % 4).cast("int"))
    return seg.segment_with_clusters(emp, AS_OF)


# ---------------------------------------------------------------------------
# 2.5 features
# ---------------------------------------------------------------------------

CUTOFF = AS_OF - _dt.timedelta(days=C.FREQUENCY_WINDOW_DAYS)


@q("agg1_last_contact", S.with_base() + "SELECT employer_id, max(interaction_date) AS last_contact_date "
   "FROM interactions GROUP BY employer_id")
def agg1(spark, sf):
    return fe.last_contact(_inter(spark, sf))


@q("agg2_frequency_12m", S.with_base() + f"SELECT employer_id, CAST(count(*) AS BIGINT) AS frequency_12m "
   f"FROM interactions WHERE interaction_date >= {td.sql_date(CUTOFF)} GROUP BY employer_id")
def agg2(spark, sf):
    return fe.frequency(_inter(spark, sf), AS_OF)


@q("flt1_date_cutoff", S.with_base() + "SELECT interaction_id, employer_id, interaction_date FROM interactions "
   f"WHERE interaction_date >= {td.sql_date(CUTOFF)}")
def flt1(spark, sf):
    return fe.filter_since(_inter(spark, sf), "interaction_date", CUTOFF).select(
        "interaction_id", "employer_id", "interaction_date")


@q("join1_enrich_last_contact", S.with_base() + "SELECT e.employer_id, e.company_size, l.last_contact_date "
   "FROM employers_raw e LEFT JOIN (SELECT employer_id, max(interaction_date) AS last_contact_date "
   "FROM interactions GROUP BY employer_id) l ON e.employer_id = l.employer_id")
def join1(spark, sf):
    last = fe.last_contact(_inter(spark, sf))
    return td.employers_raw(spark, sf).select("employer_id", "company_size").join(last, "employer_id", "left")


@q("join2_enrich_frequency", S.with_base() + "SELECT e.employer_id, e.status, f.frequency_12m "
   "FROM employers_raw e LEFT JOIN (SELECT employer_id, CAST(count(*) AS BIGINT) AS frequency_12m FROM interactions "
   f"WHERE interaction_date >= {td.sql_date(CUTOFF)} GROUP BY employer_id) f ON e.employer_id = f.employer_id")
def join2(spark, sf):
    freq = fe.frequency(_inter(spark, sf), AS_OF)
    return td.employers_raw(spark, sf).select("employer_id", "status").join(freq, "employer_id", "left")


@q("fil1_fill_frequency", S.with_base() + "SELECT employer_id, last_contact_date, frequency_12m FROM employers")
def fil1(spark, sf):
    return _emp(spark, sf).select("employer_id", "last_contact_date", "frequency_12m")


# ---------------------------------------------------------------------------
# 2.6 RFM + segmentation
# ---------------------------------------------------------------------------

@q("seg1_recency", S.with_base(*S.rfm_ctes()[:1]) + "SELECT employer_id, recency_days FROM rfm")
def seg1(spark, sf):
    return seg.compute_rfm(_emp(spark, sf), AS_OF).select("employer_id", "recency_days")


@q("seg1_recency_timestamp",
   "SELECT CAST(user_id AS VARCHAR) AS employer_id, CAST(floor((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - "
   "epoch_us(max(ts))) / 86400000000.0) AS BIGINT) AS recency_days FROM events GROUP BY user_id")
def seg1_ts(spark, sf):
    ev = td.event_contacts(spark, sf)
    return ev.select("employer_id", whole_days_since(ev, "last_contact_ts", EVENTS_AS_OF).alias("recency_days"))


@q("seg2_frequency_fallback", S.with_base() + "SELECT e.employer_id, CAST(coalesce(t.n, 0) AS BIGINT) AS frequency_12m "
   "FROM employers e LEFT JOIN (SELECT employer_id, count(*) AS n FROM interactions GROUP BY employer_id) t "
   "ON e.employer_id = t.employer_id")
def seg2(spark, sf):
    totals = _inter(spark, sf).groupBy("employer_id").agg(F.count(F.lit(1)).alias("total_interactions"))
    emp = (_emp(spark, sf).drop("frequency_12m").join(totals, "employer_id", "left")
           .withColumn("total_interactions", F.coalesce("total_interactions", F.lit(0))))
    return seg.compute_rfm(emp, AS_OF).select("employer_id", "frequency_12m")


def _revenue_sql(size_col="company_size", sector_col="sector") -> str:
    base = " ".join(f"WHEN '{k}' THEN {S.dbl(v)}" for k, v in C.SIZE_BASE_REVENUE.items())
    mult = " ".join(f"WHEN '{k}' THEN {S.dbl(v)}" for k, v in C.SECTOR_MULTIPLIER.items())
    return S.rne(f"(CASE {size_col} {base} ELSE {S.dbl(C.DEFAULT_BASE_REVENUE)} END) * "
                 f"(CASE {sector_col} {mult} ELSE {S.dbl(C.DEFAULT_SECTOR_MULTIPLIER)} END)", 0)


@q("seg3_revenue_estimate", S.with_base(with_revenue=False) + f"SELECT employer_id, company_size, sector, "
   f"{_revenue_sql()} AS revenue_potential FROM employers")
def seg3(spark, sf):
    emp = _emp(spark, sf, with_revenue=False)
    return seg.compute_rfm(emp, AS_OF).select("employer_id", "company_size", "sector", "revenue_potential")


@q("seg4_minmax_scaling", S.with_base(*S.rfm_ctes()[:2]) + "SELECT employer_id, "
   f"{S.scaled('recency_days', 'st.rlo', 'st.rhi')} AS recency_scaled, "
   f"{S.scaled('frequency_12m', 'st.flo', 'st.fhi')} AS frequency_scaled, "
   f"{S.scaled('revenue_potential', 'st.mlo', 'st.mhi')} AS monetary_scaled FROM rfm, rfm_stats st")
def seg4(spark, sf):
    out = seg.scale_minmax(seg.compute_rfm(_emp(spark, sf), AS_OF), seg.RFM_INPUTS)
    return out.select("employer_id", F.col("recency_days_scaled").alias("recency_scaled"),
                      F.col("frequency_12m_scaled").alias("frequency_scaled"),
                      F.col("revenue_potential_scaled").alias("monetary_scaled"))


@q("seg5_rfm_scores", S.with_base(*S.rfm_ctes()[:3]) + "SELECT employer_id, r_score, f_score, m_score FROM scored0")
def seg5(spark, sf):
    return seg.normalize_rfm(seg.compute_rfm(_emp(spark, sf), AS_OF)).select("employer_id", "r_score", "f_score", "m_score")


@q("seg6_weighted_rfm_score", S.with_base(*S.rfm_ctes()) + "SELECT employer_id, rfm_score FROM scored")
def seg6(spark, sf):
    return seg.normalize_rfm(seg.compute_rfm(_emp(spark, sf), AS_OF)).select("employer_id", "rfm_score")


@q("seg7_kmeans_clusters")
def seg7(spark, sf):
    out = seg.fit_transform(_emp(spark, sf), AS_OF, nullPolicy="keep")
    return out.select("employer_id", "r_score", "f_score", "m_score", "cluster")


@q("seg8_cluster_ranking", S.with_base(*S.segmented_ctes()) +
   f"SELECT cluster, segment_id, {S.rne('avg(rfm_score)', 4)} AS mean_rfm_score, CAST(count(*) AS BIGINT) AS employers "
   "FROM segmented GROUP BY cluster, segment_id")
def seg8(spark, sf):
    return (_fixed_segmented(spark, sf).groupBy("cluster", "segment_id")
            .agg(seg.round_half_even(F.avg("rfm_score"), 4).alias("mean_rfm_score"),
                 F.count(F.lit(1)).cast("long").alias("employers")))


@q("seg9_segment_attributes", S.with_base(*S.segmented_ctes()) +
   "SELECT employer_id, segment_id, segment_name, segment_priority, segment_action FROM segmented")
def seg9(spark, sf):
    return _fixed_segmented(spark, sf).select("employer_id", "segment_id", "segment_name", "segment_priority",
                                              "segment_action")


@q("seg10_priority_score", S.with_base(*S.segmented_ctes()) + "SELECT employer_id, rfm_score, priority_score FROM segmented")
def seg10(spark, sf):
    return _fixed_segmented(spark, sf).select("employer_id", "rfm_score", "priority_score")


@q("seg11_fit_transform")
def seg11(spark, sf):
    return seg.fit_transform(_emp(spark, sf), AS_OF, nullPolicy="keep")


@q("seg12_segment_sizes", S.with_base(*S.segmented_ctes()) +
   "SELECT segment_name, CAST(count(*) AS BIGINT) AS count FROM segmented GROUP BY segment_name")
def seg12(spark, sf):
    return seg.segment_sizes(_fixed_segmented(spark, sf))


@q("seg12_kmeans_segment_sizes")
def seg12_km(spark, sf):
    return seg.segment_sizes(seg.fit_transform(_emp(spark, sf), AS_OF, nullPolicy="keep"))


# K-Means from given centres and a given number of steps: the same fit, scoring, ranking and profile, in plain SQL too
START_CENTRES = ((0.2, 0.1, 0.2), (0.9, 0.1, 0.2), (0.9, 0.4, 0.8), (0.6, 0.6, 0.4))
LLOYD_STEPS = 4
_KMEANS_SQL = S.with_base(*S.kmeans_ctes(START_CENTRES, LLOYD_STEPS))
_FIXED_FIT = dict(startCentres=[list(c) for c in START_CENTRES], maxIter=LLOYD_STEPS, tol=0.0, nullPolicy="keep")


def _lloyd_segmented(spark, sf) -> DataFrame:
    return seg.fit_transform(_emp(spark, sf), AS_OF, **_FIXED_FIT)


@q("seg7_kmeans_given_start", _KMEANS_SQL + "SELECT employer_id, cluster FROM segmented")
def seg7_given(spark, sf):
    return _lloyd_segmented(spark, sf).select("employer_id", "cluster")


@q("seg11_given_start", _KMEANS_SQL + "SELECT employer_id, rfm_score, cluster, segment_id, segment_name, segment_priority, "
   "segment_action, priority_score FROM segmented")
def seg11_given(spark, sf):
    return _lloyd_segmented(spark, sf).select("employer_id", "rfm_score", "cluster", "segment_id", "segment_name",
                                              "segment_priority", "segment_action", "priority_score")


@q("seg11_saved_model", _KMEANS_SQL + "SELECT employer_id, rfm_score, cluster, segment_id, segment_name, priority_score FROM segmented")
def seg11_saved(spark, sf):
    """The fitted model is saved, loaded and scores the portfolio."""
    emp = materialize(_emp(spark, sf))
    path = scratch_path(spark, "segmenter")
    seg.RFMSegmenter(asOf=str(AS_OF), **_FIXED_FIT).fit(emp).save(path)
    return seg.RFMSegmenterModel.load(path).transform(emp).select(
        "employer_id", "rfm_score", "cluster", "segment_id", "segment_name", "priority_score")


@q("seg12_given_start_sizes", _KMEANS_SQL + "SELECT segment_name, CAST(count(*) AS BIGINT) AS count FROM segmented "
   "GROUP BY segment_name")
def seg12_given(spark, sf):
    return seg.segment_sizes(_lloyd_segmented(spark, sf))


@q("seg7_kmeans_converged", S.with_base() + "SELECT CAST(count(*) AS BIGINT) AS employers, CAST(4 AS BIGINT) AS clusters, "
   "CAST(0 AS BIGINT) AS centres_off_mean FROM employers WHERE last_contact_date IS NOT NULL")
def seg7_converged(spark, sf):
    """The 20-restart fit ends where Lloyd stands still: every centre is the mean of its rows (within 0.01 a score)."""
    emp = materialize(_emp(spark, sf))
    model = seg.RFMSegmenter(asOf=str(AS_OF), nullPolicy="keep").fit(emp)
    means = (model.transform(emp).where("cluster IS NOT NULL").groupBy("cluster")
             .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in seg.SCORE_COLS]))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centres])
    off = F.greatest(*[F.abs(F.col(c) - centres[F.col("cluster")][i]) for i, c in enumerate(seg.SCORE_COLS)])
    return means.agg(F.sum("n").alias("employers"), F.count(F.lit(1)).alias("clusters"),
                     F.count_if(off > 0.01).alias("centres_off_mean"))


# ---------------------------------------------------------------------------
# 2.7 profiles
# ---------------------------------------------------------------------------

@q("prf1_segment_profiles", S.with_base(*S.segmented_ctes()) + f"""
SELECT segment_name, CAST(count(employer_id) AS BIGINT) AS count,
       {S.rne('avg(recency_days)', 1)} AS avg_recency_days, {S.rne('avg(frequency_12m)', 1)} AS avg_frequency,
       {S.rne('avg(revenue_potential)', 1)} AS avg_revenue_potential, {S.rne('avg(priority_score)', 1)} AS avg_priority_score,
       {S.rne('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM segmented)', 1)} AS pct_of_total
FROM segmented WHERE segment_name IS NOT NULL GROUP BY segment_name""")
def prf1(spark, sf):
    return segment_profiles(_fixed_segmented(spark, sf))


@q("prf2_segment_report", S.with_base(*S.segmented_ctes()) + f"""
SELECT segment_name, CAST(count(employer_id) AS BIGINT) AS count, {S.rne('avg(rfm_score)', 2)} AS avg_rfm_score,
       {S.rne('avg(priority_score)', 2)} AS avg_priority_score, {S.rne('avg(revenue_potential)', 2)} AS avg_revenue_potential
FROM segmented WHERE segment_name IS NOT NULL GROUP BY segment_name""")
def prf2(spark, sf):
    return segment_profile_report(_fixed_segmented(spark, sf))


_PRF2_SELECT = ORACLE["prf2_segment_report"][len(S.with_base(*S.segmented_ctes())):]


@q("prf2_given_start_segment_report", _KMEANS_SQL + _PRF2_SELECT)
def prf2_given(spark, sf):
    return segment_profile_report(_lloyd_segmented(spark, sf))


@q("prf2_kmeans_segment_report")
def prf2_km(spark, sf):
    return segment_profile_report(seg.fit_transform(_emp(spark, sf), AS_OF, nullPolicy="keep"))


# ---------------------------------------------------------------------------
# 2.3 privacy
# ---------------------------------------------------------------------------

def _pseudo_sql(col: str, salt: str = FIXED_SALT) -> str:
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE 'anon_' || substr(sha256('{salt}:' || CAST({col} AS VARCHAR)), 1, 16) END"


@q("pii1_pseudonymize_employers", S.with_base() +
   f"SELECT employer_id, {_pseudo_sql('company_name')} AS company_name, sector, '{FIXED_STAMP}' AS gdpr_processed_at, "
   "true AS gdpr_pseudonymized FROM employers_raw")
def pii1(spark, sf):
    p = Pseudonymizer(FIXED_SALT)
    return p.pseudonymize_employers(td.employers_raw(spark, sf), FIXED_STAMP).select(
        "employer_id", "company_name", "sector", "gdpr_processed_at", "gdpr_pseudonymized")


@q("pii2_pseudonymize_interactions", S.with_base() +
   f"SELECT interaction_id, {_pseudo_sql(chr(39) + 'Contact ' + chr(39) + ' || employer_id')} AS contact_name, "
   "interaction_type FROM interactions")
def pii2(spark, sf):
    inter = _inter(spark, sf).withColumn("contact_name", F.concat(F.lit("Contact "), F.col("employer_id")))
    return Pseudonymizer(FIXED_SALT).pseudonymize_interactions(inter).select("interaction_id", "contact_name",
                                                                            "interaction_type")


@q("pii3_hash_value_nulls", S.with_base() +
   f"SELECT employer_id, {_pseudo_sql('CASE WHEN CAST(employer_id AS BIGINT) % 10 = 0 THEN NULL ELSE company_name END')} "
   "AS pseudonym FROM employers_raw")
def pii3(spark, sf):
    emp = td.employers_raw(spark, sf)
    val = F.when(F.col("employer_id").cast("long") % 10 == 0, F.lit(None)).otherwise(F.col("company_name"))
    return emp.select("employer_id", Pseudonymizer(FIXED_SALT).hash_column(val).alias("pseudonym"))


@q("pii4_redact_column", S.with_base() +
   "SELECT employer_id, company_size, sector, region, status, revenue_potential FROM employers_raw")
def pii4(spark, sf):
    return redact_column(redact_column(td.employers_raw(spark, sf), "company_name"), "vat_number")


@q("pii5_salt_policy")
def pii5(spark, sf):
    """Random per-run salt (no explicit salt, no GDPR_SALT): pseudonyms differ per run, rows do not."""
    p = Pseudonymizer(None)
    return td.employers_raw(spark, sf).select("employer_id", p.hash_column("company_name").alias("company_name"))


@q("pii5_random_salts", S.with_base() + "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT company_name) AS BIGINT) AS pseudonyms, "
   "CAST(0 AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS equal_in_two_runs, CAST(count(DISTINCT company_name) AS BIGINT) AS equal_with_one_salt "
   "FROM employers_raw")
def pii5_random(spark, sf):
    """Random salts: as many pseudonyms as names, all well formed, none the same in two runs; one given salt: all the same."""
    names = td.employers_raw(spark, sf).select("company_name")
    runs = [Pseudonymizer(salt).hash_column("company_name").alias(f"p{i}") for i, salt in enumerate([None, None, "given", "given"])]
    both = names.select("company_name", *runs)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("p0").alias("pseudonyms"),
                    F.count_if(~F.col("p0").rlike("^anon_[0-9a-f]{16}$")).alias("malformed"),
                    F.count_if(F.col("p0") == F.col("p1")).alias("equal_in_two_runs"),
                    F.countDistinct(F.when(F.col("p2") == F.col("p3"), F.col("p2"))).alias("equal_with_one_salt"))


# ---------------------------------------------------------------------------
# 2.2 contracts
# ---------------------------------------------------------------------------

def _contract_sql(table: str, contract: con.Contract, present: list[str], types: dict[str, str]) -> str:
    """Violations report in SQL for the columns ``present`` (types: source SQL type per column)."""
    parts = []
    for r in contract.columns:
        if r.name not in present:
            parts.append(f"SELECT '{r.name}' AS column_name, 'column_in_dataframe' AS check_name, "
                         "CAST(NULL AS BIGINT) AS failed_rows")
    aggs = []

    def add(col, chk, cond):
        aggs.append((col, chk, cond))

    for r in contract.columns:
        if r.name not in present:
            continue
        c = r.name
        src_t = types.get(c, "VARCHAR")
        if r.dtype == "double":
            typed = f"TRY_CAST({c} AS DOUBLE)" if src_t == "VARCHAR" else f"CAST({c} AS DOUBLE)"
            add(c, "coerce_double", f"{c} IS NOT NULL AND {typed} IS NULL")
            typed = f"(CASE WHEN NOT isnan({typed}) THEN {typed} END)"
        elif r.dtype == "long":
            d = f"TRY_CAST({c} AS DOUBLE)" if src_t == "VARCHAR" else f"CAST({c} AS DOUBLE)"
            typed = f"(CASE WHEN {d} IS NOT NULL AND NOT isnan({d}) AND {d} = floor({d}) THEN CAST({d} AS BIGINT) END)"
            add(c, "coerce_long", f"{c} IS NOT NULL AND {typed} IS NULL")
        else:
            typed = f"CAST({c} AS VARCHAR)"
        if not r.nullable:
            add(c, "not_nullable", f"{c} IS NULL")
        if r.isin is not None:
            add(c, "isin", f"{typed} IS NOT NULL AND {typed} NOT IN ({S.in_list(r.isin)})")
        if r.greater_than is not None:
            add(c, f"greater_than({r.greater_than:g})", f"{typed} <= {r.greater_than}")
        if r.greater_equal is not None:
            add(c, f"greater_than_or_equal_to({r.greater_equal:g})", f"{typed} < {r.greater_equal}")
    for col, chk, cond in aggs:
        parts.append(f"SELECT '{col}' AS column_name, '{chk}' AS check_name, "
                     f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failed_rows FROM {table}")
    for r in contract.columns:
        if r.unique and r.name in present:
            parts.append(f"SELECT '{r.name}' AS column_name, 'unique' AS check_name, CAST(coalesce(sum(n) FILTER "
                         f"(WHERE n > 1), 0) AS BIGINT) AS failed_rows FROM (SELECT {r.name}, count(*) AS n FROM {table} "
                         f"GROUP BY {r.name})")
    return "\nUNION ALL\n".join(parts)


EMP_TYPES = {"revenue_potential": "DOUBLE", "frequency_12m": "BIGINT", "last_contact_date": "DATE"}
EMP_COLS = [r.name for r in con.EMPLOYER_CONTRACT.columns]
INT_COLS = [r.name for r in con.INTERACTION_CONTRACT.columns]

_CON1_SQL = S.with_base(S.dirty_employers_cte()) + _contract_sql("dirty_employers", con.EMPLOYER_CONTRACT, EMP_COLS, EMP_TYPES)
_CON2_SQL = S.with_base(S.dirty_interactions_cte()) + _contract_sql("dirty_interactions", con.INTERACTION_CONTRACT,
                                                                      INT_COLS, {"interaction_date": "DATE"})


def _dirty_emp(spark, sf):
    return td.dirty_employers(_emp(spark, sf))


def _dirty_int(spark, sf):
    return td.dirty_interactions(_inter(spark, sf))


@q("con1_employer_contract", _CON1_SQL)
def con1(spark, sf):
    return con.validate_contract(_dirty_emp(spark, sf), con.EMPLOYER_CONTRACT, mode="report")


@q("con2_interaction_contract", _CON2_SQL)
def con2(spark, sf):
    return con.validate_contract(_dirty_int(spark, sf), con.INTERACTION_CONTRACT, mode="report")


_CON3_PRESENT = [c for c in EMP_COLS if c not in ("sector", "frequency_12m")]


@q("con3_required_columns", S.with_base(S.dirty_employers_cte()) +
   _contract_sql("dirty_employers", con.EMPLOYER_CONTRACT, _CON3_PRESENT, EMP_TYPES))
def con3(spark, sf):
    return con.violations(_dirty_emp(spark, sf).drop("sector", "frequency_12m"), con.EMPLOYER_CONTRACT)


_TEXT_EMP = """text_employers AS (
  SELECT employer_id,
         CASE WHEN CAST(employer_id AS BIGINT) % 61 = 8 THEN 'abc' ELSE CAST(revenue_potential AS VARCHAR) END AS revenue_potential,
         CASE WHEN CAST(employer_id AS BIGINT) % 59 = 9 THEN '2.5' ELSE CAST(CAST(frequency_12m AS DOUBLE) AS VARCHAR) END AS frequency_12m
  FROM employers)"""


@q("con4_type_coercion", S.with_base(_TEXT_EMP) + """SELECT employer_id,
  TRY_CAST(revenue_potential AS DOUBLE) AS revenue_potential,
  CASE WHEN TRY_CAST(frequency_12m AS DOUBLE) = floor(TRY_CAST(frequency_12m AS DOUBLE))
       THEN CAST(TRY_CAST(frequency_12m AS DOUBLE) AS BIGINT) END AS frequency_12m,
  (revenue_potential IS NOT NULL AND TRY_CAST(revenue_potential AS DOUBLE) IS NULL) AS revenue_invalid,
  (frequency_12m IS NOT NULL AND NOT coalesce(TRY_CAST(frequency_12m AS DOUBLE) = floor(TRY_CAST(frequency_12m AS DOUBLE)), false)) AS frequency_invalid
FROM text_employers""")
def con4(spark, sf):
    emp = _emp(spark, sf)
    k = F.col("employer_id").cast("long")
    text = emp.select(
        "employer_id",
        F.when(k % 61 == 8, F.lit("abc")).otherwise(F.col("revenue_potential").cast("string")).alias("revenue_potential"),
        F.when(k % 59 == 9, F.lit("2.5")).otherwise(F.col("frequency_12m").cast("double").cast("string")).alias("frequency_12m"))
    st = text.schema
    rev = con.coerce(F.col("revenue_potential"), st["revenue_potential"].dataType, "double")
    frq = con.coerce(F.col("frequency_12m"), st["frequency_12m"].dataType, "long")
    return text.select("employer_id", rev.alias("revenue_potential"), frq.alias("frequency_12m"),
                       (F.col("revenue_potential").isNotNull() & rev.isNull()).alias("revenue_invalid"),
                       (F.col("frequency_12m").isNotNull() & frq.isNull()).alias("frequency_invalid"))


def _con_subset(name: str, checks: tuple[str, ...]):
    sql = f"SELECT * FROM ({_CON1_SQL}) WHERE check_name IN ({S.in_list(checks)})"
    # the WITH clause sits inside the subquery

    @q(name, sql)
    def run(spark, sf):
        return con.violations(_dirty_emp(spark, sf), con.EMPLOYER_CONTRACT).filter(F.col("check_name").isin(list(checks)))
    return run


_con_subset("con5_not_null", ("not_nullable",))
_con_subset("con6_unique_key", ("unique",))
_con_subset("con7_value_in_set", ("isin",))
_con_subset("con8_bounds", ("greater_than(0)", "greater_than_or_equal_to(0)"))


_QUARANTINE_SQL = (S.with_base(S.dirty_employers_cte()) + f"""
SELECT employer_id, company_name, company_size, sector, region, status, revenue_potential,
       CAST(last_contact_date AS VARCHAR) AS last_contact_date, frequency_12m
FROM dirty_employers
WHERE employer_id IS NOT NULL AND company_size IS NOT NULL AND status IS NOT NULL
  AND company_size IN ({S.in_list(C.VALID_SIZES)}) AND status IN ({S.in_list(C.VALID_STATUSES)})
  AND (sector IS NULL OR sector IN ({S.in_list(C.VALID_SECTORS)}))
  AND NOT coalesce(revenue_potential <= 0, false) AND NOT coalesce(frequency_12m < 0, false)
  AND employer_id NOT IN (SELECT employer_id FROM dirty_employers WHERE employer_id IS NOT NULL
                          GROUP BY employer_id HAVING count(*) > 1)""")


@q("con_quarantine_good_rows", _QUARANTINE_SQL)
def con_quarantine(spark, sf):
    good, _bad = con.validate_contract(_dirty_emp(spark, sf), con.EMPLOYER_CONTRACT, mode="quarantine")
    return good


# ---------------------------------------------------------------------------
# 2.4 data quality
# ---------------------------------------------------------------------------

ASOF_TS = f"TIMESTAMP '{AS_OF.isoformat()} 00:00:00'"


def _dq_sql(table: str, checks, dataset: str, present: list[str], doubles=(), parent: str | None = None) -> str:
    """The report of ``checks`` over ``table`` in SQL (one SELECT per check, UNION ALL)."""
    total = f"(SELECT count(*) FROM {table})"
    rows = []

    def row(name, passed, details, sev, affected):
        rows.append(f"SELECT '{dataset}' AS dataset_name, '{name}' AS check_name, {passed} AS passed, "
                    f"{details} AS details, '{sev}' AS severity, CAST({affected} AS BIGINT) AS affected_rows, "
                    f"CAST({total} AS BIGINT) AS total_rows")

    def ok_or(n, msg):
        return f"CASE WHEN {n} = 0 THEN 'OK' ELSE CAST({n} AS VARCHAR) || {msg} END"

    for chk in checks:
        c = chk.column
        if c is not None and c not in present:
            if chk.kind in ("no_nulls", "missing_rate"):
                row(f"column_exists:{c}", "false", f"'column ''{c}'' is missing'", "error", 0)
            elif chk.kind == "value_set":
                row(f"value_set:{c}", "false", f"'column ''{c}'' is missing'", "error", 0)
            else:
                row(f"{chk.kind}:{c}", "true", "'column not present'", chk.severity, 0)
            continue
        k = chk.kind
        if k in ("no_nulls", "missing_rate"):
            cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in doubles else "")
            n = f"(SELECT count(*) FROM {table} WHERE {cond})"
            if k == "no_nulls":
                row(f"no_nulls:{c}", f"{n} = 0", ok_or(n, S._q(f" null values in '{c}'")), chk.severity, n)
            else:
                row(f"missing_rate:{c}", f"CAST({n} AS DOUBLE) / greatest({total}, 1) <= {chk.threshold}",
                    ok_or(n, S._q(f" null values in '{c}' (share above {chk.threshold:g})")), chk.severity, n)
        elif k == "unique":
            n = f"(SELECT coalesce(sum(cnt - 1), 0) FROM (SELECT {c}, count(*) AS cnt FROM {table} GROUP BY {c}))"
            row(f"unique:{c}", f"{n} = 0", ok_or(n, S._q(f" duplicates in '{c}'")), "error", n)
        elif k == "value_set":
            bad = f"NOT coalesce({c} IN ({S.in_list(chk.values)}), false)"
            n = f"(SELECT count(*) FROM {table} WHERE {bad})"
            sample = (f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'None') "
                      f"AS v FROM {table} WHERE {bad} ORDER BY v LIMIT 5))")
            row(f"value_set:{c}", f"{n} = 0",
                f"CASE WHEN {n} = 0 THEN 'OK' ELSE CAST({n} AS VARCHAR) || ' invalid values: [' || coalesce({sample}, '') || ']' END",
                "error", n)
        elif k == "not_future":
            n = f"(SELECT count(*) FROM {table} WHERE TRY_CAST({c} AS TIMESTAMP) > {ASOF_TS})"
            row(f"not_future:{c}", f"{n} = 0", ok_or(n, S._q(" dates in the future")), "error", n)
        elif k == "freshness":
            n = (f"(SELECT count(*) FROM {table} WHERE TRY_CAST({c} AS TIMESTAMP) < "
                 f"{ASOF_TS} - INTERVAL {chk.max_age_days} DAY)")
            row(f"freshness:{c}", f"{n} = 0", ok_or(n, S._q(f" rows older than {chk.max_age_days} days")), "warning", n)
        elif k == "positive":
            n = f"(SELECT count(*) FROM {table} WHERE {c} <= 0)"
            row(f"positive:{c}", f"{n} = 0", ok_or(n, S._q(f" non-positive values in '{c}'")), chk.severity, n)
        elif k == "min_row_count":
            row(f"min_row_count:{chk.dataset}", f"{total} >= {chk.min_rows}",
                f"CASE WHEN {total} < {chk.min_rows} THEN 'only ' || CAST({total} AS VARCHAR) || ' rows (minimum: "
                f"{chk.min_rows})' ELSE 'OK' END", "error", 0)
        elif k == "ref_integrity":
            if parent is None:
                row(f"ref_integrity:{c}", "true", "'needs a join with the parent table'", "info", 0)
                continue
            n = (f"(SELECT coalesce(sum(cnt), 0) FROM (SELECT {c} AS k, count(*) AS cnt FROM {table} WHERE {c} IS NOT NULL "
                 f"GROUP BY {c}) x WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c} = x.k))")
            row(f"ref_integrity:{c}", f"{n} = 0", ok_or(n, S._q(f" rows without a parent in '{c}'")), "info", n)
    return "\nUNION ALL\n".join(rows)


_DEMP_COLS = ["employer_id", "company_name", "company_size", "sector", "region", "status", "revenue_potential",
              "last_contact_date", "frequency_12m"]
_DINT_COLS = ["interaction_id", "employer_id", "interaction_date", "interaction_type", "outcome",
              "follow_up_required", "consultant_id"]
_DEMP_BASE = S.with_base(S.dirty_employers_cte())
_DINT_BASE = S.with_base(S.dirty_interactions_cte())


def _dq_emp(name: str, checks, dataset="Employers"):
    sql = _DEMP_BASE + _dq_sql("dirty_employers", checks, dataset, _DEMP_COLS, doubles=("revenue_potential",))

    @q(name, sql)
    def run(spark, sf):
        return dq.validate(_dirty_emp(spark, sf), checks, dataset, AS_OF)
    return run


_dq_emp("dq1_no_nulls", (dq.no_nulls("employer_id"), dq.no_nulls("last_contact_date", "warning"), dq.no_nulls("vat_number")))
_dq_emp("dq2_unique", (dq.unique("employer_id"),))
_dq_emp("dq3_value_set", (dq.value_set("company_size", C.VALID_SIZES), dq.value_set("status", C.VALID_STATUSES),
                          dq.value_set("sector", C.VALID_SECTORS), dq.value_set("contact_channel", ("email",))))
_dq_emp("dq4_not_future", (dq.not_future("last_contact_date"), dq.not_future("acquisition_date")))
_dq_emp("dq5_freshness", (dq.freshness("last_contact_date"),))
_dq_emp("dq6_positive", (dq.positive("revenue_potential", "warning"), dq.positive("employee_count")))
_dq_emp("dq7_row_count", (dq.min_row_count(C.EMPLOYERS_MIN_ROWS, "Employers"), dq.min_row_count(10 ** 12, "All")))
_dq_emp("dq9_validate_employers", dq.EMPLOYER_CHECKS)
_dq_emp("ext3_missing_rate", (dq.missing_rate("last_contact_date"), dq.missing_rate("region"),
                              dq.missing_rate("sector", 0.0), dq.missing_rate("phone_number")))

_DQ8_CHECKS = (dq.ref_integrity("employer_id"),)


@q("dq8_ref_integrity", _DINT_BASE + _dq_sql("dirty_interactions", _DQ8_CHECKS, "Interactions", _DINT_COLS,
                                             parent="employers_raw"))
def dq8(spark, sf):
    return dq.validate(_dirty_int(spark, sf), _DQ8_CHECKS, "Interactions", AS_OF,
                       parent=td.employers_raw(spark, sf), parent_key="employer_id")


_DQ10_SQL = _DINT_BASE + _dq_sql("dirty_interactions", dq.INTERACTION_CHECKS, "Interactions", _DINT_COLS,
                                 parent="employers_raw")


@q("dq10_validate_interactions", _DQ10_SQL)
def dq10(spark, sf):
    return dq.validate_interactions(_dirty_int(spark, sf), AS_OF, td.employers_raw(spark, sf))


@q("dq10_merged_daily_states", _DQ10_SQL)
def dq10_merged(spark, sf):
    """The same report from kept states: one of the history, one of the rows after it."""
    inter = _dirty_int(spark, sf)
    later = F.coalesce(F.col("interaction_date") >= F.lit(_dt.date(2001, 7, 1)), F.lit(False))
    path = _scratch(spark, "report-states")
    for name, part in (("history", ~later), ("later", later)):
        dq.report_state(inter.filter(part), dq.INTERACTION_CHECKS).write.parquet(f"{path}/{name}")
    kept = spark.read.schema(dq.STATE_SCHEMA).parquet(f"{path}/history", f"{path}/later")
    return dq.report_from_state(dq.merge_states(kept), dq.INTERACTION_CHECKS, "Interactions", AS_OF, inter.columns,
                                td.employers_raw(spark, sf), "employer_id")


_DQ9_SQL = _DEMP_BASE + _dq_sql("dirty_employers", dq.EMPLOYER_CHECKS, "Employers", _DEMP_COLS,
                                doubles=("revenue_potential",))
_BOTH_REPORTS = (f"reports AS (SELECT * FROM ({_DQ9_SQL}) UNION ALL SELECT * FROM ({_DQ10_SQL}))")
_SUMMARY_SQL = ("SELECT dataset_name, count(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS passed, "
                "CAST(count(*) FILTER (WHERE NOT passed AND severity = 'error') AS BIGINT) AS error_count, "
                "CAST(count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS BIGINT) AS warning_count, "
                "max(total_rows) AS total_rows FROM reports GROUP BY dataset_name")


def _both_reports(spark, sf):
    return dq.validate_employers(_dirty_emp(spark, sf), AS_OF).unionByName(
        dq.validate_interactions(_dirty_int(spark, sf), AS_OF, td.employers_raw(spark, sf)))


@q("dq11_report_summary", f"WITH {_BOTH_REPORTS} {_SUMMARY_SQL}")
def dq11(spark, sf):
    return dq.report_summary(_both_reports(spark, sf))


@q("dq12_quality_gate", f"WITH {_BOTH_REPORTS}, summary AS ({_SUMMARY_SQL}) SELECT dataset_name, passed, "
   "CASE WHEN passed THEN 'continue' WHEN dataset_name = 'Employers' THEN 'stop' ELSE 'warn' END AS action FROM summary")
def dq12(spark, sf):
    """Each report through the gate: an employer failure stops a run, an interaction failure is a warning."""
    reports = {"Employers": dq.validate_employers(_dirty_emp(spark, sf), AS_OF),
               "Interactions": dq.validate_interactions(_dirty_int(spark, sf), AS_OF, td.employers_raw(spark, sf))}
    rows = []
    for name, frame in reports.items():
        report, action = dq.ValidationReport.collect(frame), "continue"
        try:
            dq.gate(report)
        except dq.DataQualityError:
            action = "stop" if name == "Employers" else "warn"
        rows.append((name, report.passed, action))
    return spark.createDataFrame(rows, "dataset_name string, passed boolean, action string")


# ---------------------------------------------------------------------------
# 2.8 measures
# ---------------------------------------------------------------------------

@q("m1_active_employers", S.with_base() + "SELECT sector, CAST(count(*) FILTER (WHERE status = 'Active') AS BIGINT) "
   "AS active_employers FROM employers_raw GROUP BY sector")
def m1(spark, sf):
    return ms.active_employers(td.employers_raw(spark, sf), by=["sector"])


@q("m2_avg_interactions_per_employer", S.with_base(
    "daily AS (SELECT e.sector, i.interaction_date AS d, count(*) AS n FROM interactions i LEFT JOIN employers_raw e "
    "ON i.employer_id = e.employer_id GROUP BY 1, 2)",
    "lastd AS (SELECT sector, max(d) AS last_d FROM daily GROUP BY sector)",
    "num AS (SELECT daily.sector, CAST(sum(CASE WHEN d > last_d - INTERVAL 12 MONTH AND d <= last_d THEN n END) AS BIGINT) "
    "AS i12 FROM daily JOIN lastd ON daily.sector IS NOT DISTINCT FROM lastd.sector GROUP BY daily.sector)",
    "den AS (SELECT sector, CAST(count(*) FILTER (WHERE status = 'Active') AS BIGINT) AS act FROM employers_raw GROUP BY sector)")
   + "SELECT coalesce(den.sector, num.sector) AS sector, CAST(coalesce(i12, 0) AS BIGINT) AS interactions_12m, "
   "CAST(coalesce(act, 0) AS BIGINT) AS active_employers, CASE WHEN coalesce(act, 0) = 0 THEN 0.0::DOUBLE "
   "ELSE CAST(coalesce(i12, 0) AS DOUBLE) / CAST(act AS DOUBLE) END AS avg_interactions_per_employer "
   "FROM den FULL JOIN num ON den.sector IS NOT DISTINCT FROM num.sector")
def m2(spark, sf):
    return ms.avg_interactions_per_employer(_inter(spark, sf), td.employers_raw(spark, sf), by=["sector"])


@q("m2_avg_interactions_global", S.with_base() +
   "SELECT CAST((SELECT count(*) FROM interactions WHERE interaction_date > (SELECT max(interaction_date) FROM interactions) "
   "- INTERVAL 12 MONTH AND interaction_date <= (SELECT max(interaction_date) FROM interactions)) AS BIGINT) AS interactions_12m, "
   "CAST((SELECT count(*) FROM employers_raw WHERE status = 'Active') AS BIGINT) AS active_employers, "
   "CAST((SELECT count(*) FROM interactions WHERE interaction_date > (SELECT max(interaction_date) FROM interactions) "
   "- INTERVAL 12 MONTH AND interaction_date <= (SELECT max(interaction_date) FROM interactions)) AS DOUBLE) / "
   "CAST((SELECT count(*) FROM employers_raw WHERE status = 'Active') AS DOUBLE) AS avg_interactions_per_employer")
def m2_global(spark, sf):
    return ms.avg_interactions_per_employer(_inter(spark, sf), td.employers_raw(spark, sf))


@q("m3_total_revenue_potential", S.with_base() + f"SELECT sector, {S.rne('sum(revenue_potential)', 2)} AS "
   "total_revenue_potential FROM employers_raw GROUP BY sector")
def m3(spark, sf):
    return ms.total_revenue_potential(td.employers_raw(spark, sf), by=["sector"]).withColumn(
        "total_revenue_potential", seg.round_half_even(F.col("total_revenue_potential"), 2))


_CHURN_PER = (f"per AS (SELECT employer_id, max(interaction_date) AS last_d, count(*) FILTER (WHERE interaction_date > "
              f"{S.ASOF} - INTERVAL 12 MONTH AND interaction_date <= {S.ASOF}) AS f FROM interactions GROUP BY employer_id)")
_CHURN_SCORE = ("round((CASE WHEN p.last_d IS NULL THEN 1.0::DOUBLE ELSE least(CAST(date_diff('day', p.last_d, "
                f"{S.ASOF}) AS DOUBLE) / 365.0::DOUBLE, 1.0::DOUBLE) END * 0.6::DOUBLE + (1.0::DOUBLE - "
                "least(CAST(coalesce(p.f, 0) AS DOUBLE) / 24.0::DOUBLE, 1.0::DOUBLE)) * 0.4::DOUBLE) * 100.0::DOUBLE, 0)")
_CHURN_CTE = (f"churn AS (SELECT e.*, p.last_d AS last_interaction_date, CAST(date_diff('day', p.last_d, {S.ASOF}) AS BIGINT) "
              f"AS days_since_contact, CAST(coalesce(p.f, 0) AS BIGINT) AS interactions_12m, {_CHURN_SCORE} AS churn_risk_score "
              "FROM employers_raw e LEFT JOIN per p ON e.employer_id = p.employer_id)")


@q("m4_churn_risk_score", S.with_base(_CHURN_PER, _CHURN_CTE) +
   "SELECT employer_id, last_interaction_date, days_since_contact, interactions_12m, churn_risk_score FROM churn")
def m4(spark, sf):
    return ms.churn_risk(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF)


def _pct_high_sql(op: str) -> str:
    return (S.with_base(_CHURN_PER, _CHURN_CTE) +
            f"SELECT sector, CAST(count(*) FILTER (WHERE churn_risk_score {op} 70) AS BIGINT) AS high_churn_employers, "
            "CAST(count(*) FILTER (WHERE status = 'Active') AS BIGINT) AS active_employers, "
            f"CASE WHEN count(*) FILTER (WHERE status = 'Active') = 0 THEN 0.0::DOUBLE ELSE "
            f"CAST(count(*) FILTER (WHERE churn_risk_score {op} 70) AS DOUBLE) / "
            "CAST(count(*) FILTER (WHERE status = 'Active') AS DOUBLE) END AS pct_high_churn FROM churn GROUP BY sector")


@q("m5_pct_high_churn", _pct_high_sql(">"))
def m5(spark, sf):
    return ms.pct_high_churn(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF, by=["sector"])


@q("glo2_high_churn_inclusive", _pct_high_sql(">="))
def glo2(spark, sf):
    return ms.pct_high_churn(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF, by=["sector"], inclusive=True)


def _label_sql() -> str:
    parts = []
    for bound, floor_, label in C.PRIORITY_LABELS:
        if bound is None:
            parts.append(f"ELSE '{label}'")
            continue
        cond = f"churn_risk_score < {bound}"
        if floor_ is not None:
            cond += f" AND coalesce(revenue_potential, 0.0) > {floor_}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


@q("m6_segment_priority_label", S.with_base(_CHURN_PER, _CHURN_CTE) +
   f"SELECT employer_id, revenue_potential, churn_risk_score, {_label_sql()} AS priority_label FROM churn")
def m6(spark, sf):
    return ms.segment_priority_labels(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF)


@q("m7_segment_share", S.with_base(*S.segmented_ctes()) +
   "SELECT status, segment_name, CAST(count(*) AS BIGINT) AS employers, CAST(count(*) AS DOUBLE) / "
   "CAST(sum(count(*)) OVER (PARTITION BY status) AS DOUBLE) AS segment_share FROM segmented GROUP BY status, segment_name")
def m7(spark, sf):
    return ms.segment_share(_fixed_segmented(spark, sf), by=["status"])


_MONTHS = ("bounds AS (SELECT CAST(date_trunc('month', min(interaction_date)) AS TIMESTAMP) AS lo, "
           "CAST(date_trunc('month', max(interaction_date)) AS TIMESTAMP) AS hi FROM interactions)",
           "months AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM bounds)",
           "mcounts AS (SELECT CAST(date_trunc('month', interaction_date) AS DATE) AS month_start, count(*) AS n "
           "FROM interactions GROUP BY 1)",
           "dense AS (SELECT m.month_start, CAST(coalesce(c.n, 0) AS BIGINT) AS interactions FROM months m "
           "LEFT JOIN mcounts c ON m.month_start = c.month_start)",
           "ytd AS (SELECT *, CAST(sum(interactions) OVER (PARTITION BY year(month_start) ORDER BY month_start ROWS BETWEEN "
           "UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS interactions_ytd, lag(interactions) OVER (ORDER BY month_start) "
           "AS previous_month FROM dense)")


@q("m8_interactions_ytd", S.with_base(*_MONTHS) + "SELECT month_start, interactions, interactions_ytd FROM ytd")
def m8(spark, sf):
    return ms.interactions_ytd(_inter(spark, sf))


@q("m9_mom_growth", S.with_base(*_MONTHS) + "SELECT month_start, interactions, interactions_ytd, previous_month, "
   "CASE WHEN previous_month IS NULL OR previous_month = 0 THEN NULL ELSE CAST(interactions_ytd - previous_month AS DOUBLE) "
   "/ CAST(previous_month AS DOUBLE) END AS mom_growth FROM ytd")
def m9(spark, sf):
    return ms.mom_growth(_inter(spark, sf))


@q("m10_rolling_3m", S.with_base(*_MONTHS, "daily AS (SELECT interaction_date AS d, count(*) AS n FROM interactions GROUP BY 1)")
   + "SELECT y.month_start, y.interactions, (SELECT CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM daily WHERE "
   "d > least(last_day(y.month_start), (SELECT max(d) FROM daily)) - INTERVAL 3 MONTH AND d <= last_day(y.month_start)) "
   "AS rolling_3m_interactions FROM ytd y")
def m10(spark, sf):
    return ms.rolling_3m(_inter(spark, sf))


@q("m10_rolling_3m_daily", S.with_base(
    "b AS (SELECT CAST(min(interaction_date) AS TIMESTAMP) AS lo, CAST(max(interaction_date) AS TIMESTAMP) AS hi FROM interactions)",
    "days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)",
    "daily AS (SELECT interaction_date AS d, count(*) AS n FROM interactions GROUP BY 1)")
   + "SELECT days.date, CAST(coalesce((SELECT n FROM daily WHERE d = days.date), 0) AS BIGINT) AS interactions, "
   "(SELECT CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM daily WHERE d > days.date - INTERVAL 3 MONTH "
   "AND d <= days.date) AS rolling_3m_interactions FROM days")
def m10_daily(spark, sf):
    return ms.rolling_3m_daily(_inter(spark, sf))


@q("m10_rolling_3m_changes", S.with_base(
    "daily AS (SELECT consultant_id AS c, interaction_date AS d, count(*) AS n FROM interactions GROUP BY 1, 2)",
    "b AS (SELECT min(d) AS lo, max(d) AS hi FROM daily)",
    "days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS x FROM b)",
    "gone AS (SELECT e.d AS d, min(x) AS x FROM (SELECT DISTINCT d FROM daily) e JOIN days ON x > e.d "
    "AND x <= e.d + INTERVAL 5 MONTH AND CAST(x - INTERVAL 3 MONTH AS DATE) >= e.d GROUP BY e.d)",
    "steps AS (SELECT c, d AS x FROM daily UNION SELECT c, gone.x FROM daily JOIN gone USING (d))",
    "win AS (SELECT s.c, s.x, sum(CASE WHEN d = s.x THEN n ELSE 0 END) AS today, sum(n) AS n, count(n) AS days FROM steps s "
    "LEFT JOIN daily ON daily.c IS NOT DISTINCT FROM s.c AND d <= s.x AND d > CAST(s.x - INTERVAL 3 MONTH AS DATE) GROUP BY s.c, s.x)")
   + "SELECT c AS consultant_id, x AS date, CAST(coalesce(lead(x) OVER (PARTITION BY c ORDER BY x) - 1, (SELECT hi FROM b)) "
   "AS DATE) AS until, CAST(today AS BIGINT) AS interactions, CASE WHEN days > 0 THEN CAST(n AS DOUBLE) / CAST(days AS DOUBLE) "
   "END AS rolling_3m_interactions FROM win")
def m10_changes(spark, sf):
    return ms.rolling_3m_changes(_inter(spark, sf), by=["consultant_id"])


@q("m11_avg_time_to_fill", S.with_base() + "SELECT status, avg(date_diff('day', open_date, filled_date)) AS avg_time_to_fill "
   "FROM vacancies GROUP BY status")
def m11(spark, sf):
    return ms.avg_time_to_fill(td.vacancies(spark, sf), by=["status"])


@q("m12_placement_ratio", S.with_base() + "SELECT CAST(count(*) FILTER (WHERE status = 'Filled') AS BIGINT) AS filled, "
   "CAST(count(*) AS BIGINT) AS vacancies, CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE "
   "CAST(count(*) FILTER (WHERE status = 'Filled') AS DOUBLE) / CAST(count(*) AS DOUBLE) END AS placement_ratio FROM vacancies")
def m12(spark, sf):
    return ms.placement_ratio(td.vacancies(spark, sf))


@q("m13_safe_divide", S.with_base() + "SELECT sector, CASE WHEN count(*) FILTER (WHERE status = 'Active') = 0 THEN 0.0::DOUBLE "
   "ELSE sum(revenue_potential) / CAST(count(*) FILTER (WHERE status = 'Active') AS DOUBLE) END AS revenue_per_active_employer "
   "FROM employers_raw GROUP BY sector")
def m13(spark, sf):
    emp = td.employers_raw(spark, sf)
    agg = emp.groupBy("sector").agg(F.sum("revenue_potential").alias("rev"),
                                    F.count_if(F.col("status") == "Active").alias("act"))
    return agg.select("sector", safe_divide(F.col("rev"), F.col("act"), 0).alias("revenue_per_active_employer"))


@q("m14_period_window", S.with_base() + "SELECT consultant_id, CAST(count(*) AS BIGINT) AS interactions_12m FROM interactions "
   f"WHERE interaction_date > {S.ASOF} - INTERVAL 12 MONTH AND interaction_date <= {S.ASOF} GROUP BY consultant_id")
def m14(spark, sf):
    inter = _inter(spark, sf).filter(in_months_window(F.col("interaction_date"), AS_OF, 12))
    return inter.groupBy("consultant_id").agg(F.count(F.lit(1)).cast("long").alias("interactions_12m"))


@q("m8_interactions_ytd_by_outcome", S.with_base(
    "bounds AS (SELECT CAST(date_trunc('month', min(interaction_date)) AS TIMESTAMP) AS lo, "
    "CAST(date_trunc('month', max(interaction_date)) AS TIMESTAMP) AS hi FROM interactions)",
    "grid AS (SELECT t.outcome, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start "
    "FROM (SELECT DISTINCT nullif(outcome, 'Positive') AS outcome FROM interactions) t, bounds)",
    "c AS (SELECT nullif(outcome, 'Positive') AS outcome, CAST(date_trunc('month', interaction_date) AS DATE) AS month_start, "
    "count(*) AS n FROM interactions GROUP BY 1, 2)",
    "dense AS (SELECT g.outcome, g.month_start, CAST(coalesce(c.n, 0) AS BIGINT) AS interactions FROM grid g "
    "LEFT JOIN c ON g.outcome IS NOT DISTINCT FROM c.outcome AND g.month_start = c.month_start)")
   + "SELECT outcome, month_start, interactions, CAST(sum(interactions) OVER (PARTITION BY outcome, year(month_start) "
   "ORDER BY month_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS interactions_ytd FROM dense")
def m8_by_outcome(spark, sf):
    """One outcome is made null, so that the null group has rows."""
    inter = _inter(spark, sf)
    return ms.interactions_ytd(inter.withColumn("outcome", F.nullif("outcome", F.lit("Positive"))), by=["outcome"])


@q("m15_previous_month", S.with_base(*_MONTHS) + "SELECT month_start, interactions, previous_month FROM ytd")
def m15(spark, sf):
    return previous_month(monthly_counts(_inter(spark, sf)), "interactions")


@q("m15_previous_month_by_type", S.with_base(
    "bounds AS (SELECT CAST(date_trunc('month', min(interaction_date)) AS TIMESTAMP) AS lo, "
    "CAST(date_trunc('month', max(interaction_date)) AS TIMESTAMP) AS hi FROM interactions)",
    "grid AS (SELECT t.interaction_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start "
    "FROM (SELECT DISTINCT interaction_type FROM interactions) t, bounds)",
    "c AS (SELECT interaction_type, CAST(date_trunc('month', interaction_date) AS DATE) AS month_start, count(*) AS n "
    "FROM interactions GROUP BY 1, 2)",
    "dense AS (SELECT g.interaction_type, g.month_start, CAST(coalesce(c.n, 0) AS BIGINT) AS interactions FROM grid g "
    "LEFT JOIN c ON g.interaction_type = c.interaction_type AND g.month_start = c.month_start)")
   + "SELECT interaction_type, month_start, interactions, lag(interactions) OVER (PARTITION BY interaction_type "
   "ORDER BY month_start) AS previous_month FROM dense")
def m15_by(spark, sf):
    return previous_month(monthly_counts(_inter(spark, sf), by=["interaction_type"]), "interactions", by=["interaction_type"])


@q("glo1_active_employers_glossary", S.with_base() + "SELECT * FROM employers_raw WHERE status = 'Active' AND employer_id IN "
   f"(SELECT employer_id FROM interactions WHERE interaction_date > {S.ASOF} - INTERVAL 12 MONTH AND interaction_date <= {S.ASOF})")
def glo1(spark, sf):
    return ms.active_employers_glossary(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF)


# ---------------------------------------------------------------------------
# 2.9 star schema
# ---------------------------------------------------------------------------

@q("dim1_date_dimension", S.with_base(
    "b AS (SELECT CAST(min(interaction_date) AS TIMESTAMP) AS lo, CAST(max(interaction_date) AS TIMESTAMP) AS hi FROM interactions)",
    "days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)")
   + "SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, "
   "CAST(month(date) AS INTEGER) AS month, CAST(date_trunc('month', date) AS DATE) AS month_start, last_day(date) AS month_end, "
   "CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week FROM days")
def dim1(spark, sf):
    return date_dimension(_inter(spark, sf))


@q("dim2_segment_dimension", S.with_base(*S.segmented_ctes()) +
   "SELECT DISTINCT segment_id, segment_name, segment_priority AS priority, "
   f"CASE segment_id {' '.join(f'WHEN {s[0]} THEN {S._q(s[2])}' for s in C.SEGMENTS)} END AS color_hex, "
   "segment_action AS recommended_action FROM segmented WHERE segment_id IS NOT NULL")
def dim2(spark, sf):
    return star.segment_dimension(_fixed_segmented(spark, sf))


@q("dim3_employer_dimension", S.with_base(*S.segmented_ctes()) +
   "SELECT employer_id, sector, company_size, region, status, revenue_potential, segment_name, priority_score, rfm_score "
   "FROM segmented")
def dim3(spark, sf):
    return star.employer_dimension(_fixed_segmented(spark, sf))


@q("dim4_interaction_fact", S.with_base() + "SELECT interaction_id, employer_id, consultant_id, interaction_date, "
   "interaction_type, outcome, follow_up_required FROM interactions")
def dim4(spark, sf):
    return star.interaction_fact(_inter(spark, sf))


@q("dim5_star_join", S.with_base(*S.segmented_ctes()) +
   "SELECT s.segment_name, CAST(year(i.interaction_date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS interactions, "
   "CAST(count(DISTINCT i.employer_id) AS BIGINT) AS employers FROM interactions i LEFT JOIN segmented s "
   "ON i.employer_id = s.employer_id GROUP BY 1, 2")
def dim5(spark, sf):
    fact = star.interaction_fact(_inter(spark, sf))
    return star.star_join(fact, star.employer_dimension(_fixed_segmented(spark, sf)), ("segment_name",), ("year",))


_COLOR_SQL = "CASE s.segment_id " + " ".join(f"WHEN {x[0]} THEN {S._q(x[2])}" for x in C.SEGMENTS) + " END"


@q("dim5_star_join_by_segment_and_weekday", S.with_base(*S.segmented_ctes()) +
   f"SELECT {_COLOR_SQL} AS color_hex, s.segment_priority AS priority, s.segment_action AS recommended_action, s.sector, "
   "CAST(dayofweek(i.interaction_date) + 1 AS INTEGER) AS day_of_week, last_day(i.interaction_date) AS month_end, "
   "CAST(count(*) AS BIGINT) AS interactions, CAST(count(DISTINCT i.employer_id) AS BIGINT) AS employers "
   "FROM interactions i LEFT JOIN segmented s ON i.employer_id = s.employer_id GROUP BY 1, 2, 3, 4, 5, 6")
def dim5_all(spark, sf):
    fact = star.interaction_fact(_inter(spark, sf))
    return star.star_join(fact, star.employer_dimension(_fixed_segmented(spark, sf)),
                          ("color_hex", "priority", "recommended_action", "sector"), ("day_of_week", "month_end"))


# ---------------------------------------------------------------------------
# 2.10 retention, incremental ingest, row-level security
# ---------------------------------------------------------------------------

@q("ext1_retain_employers", S.with_base() + "SELECT e.*, l.last_d IS NULL AS never_contacted FROM employers_raw e LEFT JOIN "
   "(SELECT employer_id, max(interaction_date) AS last_d FROM interactions GROUP BY employer_id) l ON e.employer_id = l.employer_id "
   f"WHERE l.last_d IS NULL OR l.last_d >= {S.ASOF} - INTERVAL 24 MONTH")
def ext1(spark, sf):
    return rt.retain_employers(td.employers_raw(spark, sf), _inter(spark, sf), AS_OF)


@q("ext2_retain_interactions", S.with_base() + f"SELECT * FROM interactions WHERE interaction_date >= {S.ASOF} - INTERVAL 36 MONTH")
def ext2(spark, sf):
    return rt.retain_interactions(_inter(spark, sf), AS_OF)


_BATCH_FROM = _dt.date(2001, 6, 1)
_HISTORY_UNTIL = _dt.date(2001, 7, 1)


@q("ext4_incremental_ingest", S.with_base() + f"SELECT * FROM interactions WHERE interaction_date >= {td.sql_date(_BATCH_FROM)} "
   f"AND interaction_id NOT IN (SELECT interaction_id FROM interactions WHERE interaction_date < {td.sql_date(_HISTORY_UNTIL)})")
def ext4(spark, sf):
    from accountlens.streaming.incremental import new_rows
    inter = _inter(spark, sf)
    history = inter.filter(F.col("interaction_date") < F.lit(_HISTORY_UNTIL))
    batch = inter.filter(F.col("interaction_date") >= F.lit(_BATCH_FROM))
    return new_rows(batch, history)


@q("ext4_append_twice", S.with_base() + "SELECT * FROM interactions")
def ext4_twice(spark, sf):
    """History, then an overlapping batch delivered twice; the table holds every interaction once."""
    from accountlens.streaming.incremental import append_new
    inter = _inter(spark, sf)
    target = _scratch(spark, "fact") + "/interactions"
    append_new(spark, inter.filter(F.col("interaction_date") < F.lit(_HISTORY_UNTIL)), target)
    batch = inter.filter((F.col("interaction_date") >= F.lit(_BATCH_FROM)) | F.col("interaction_date").isNull())
    append_new(spark, batch, target)
    append_new(spark, batch, target)
    return spark.read.parquet(target)


_ONE_DAY = _dt.date(2001, 7, 16)
_DAY_AGAIN = _dt.date(1998, 3, 3)


@q("ext4_indexed_ingest", S.with_base() + "SELECT strftime(interaction_date, '%Y%m%d') || '-' || interaction_id AS interaction_id, "
   "* EXCLUDE (interaction_id), CAST(year(interaction_date) * 100 + month(interaction_date) AS INTEGER) AS month FROM interactions "
   f"WHERE interaction_date < {td.sql_date(_HISTORY_UNTIL)} OR interaction_date = {td.sql_date(_ONE_DAY)}")
def ext4_indexed(spark, sf):
    """History by month, then one day with rows of an old day again, delivered twice; only files that may hold the keys are read."""
    from accountlens.streaming.keyindex import IndexedFact
    inter = _inter(spark, sf).withColumn("interaction_id", F.concat(
        F.date_format("interaction_date", "yyyyMMdd"), F.lit("-"), F.col("interaction_id")))
    fact = IndexedFact(spark, _scratch(spark, "fact") + "/interactions")
    fact.append(inter.filter(F.col("interaction_date") < F.lit(_HISTORY_UNTIL)))
    batch = inter.filter(F.col("interaction_date").isin(_ONE_DAY, _DAY_AGAIN))
    fact.append(batch)
    fact.append(batch)
    return fact.read()


@q("ext4_stream_ingest", S.with_base() + "SELECT * FROM interactions")
def ext4_stream(spark, sf):
    """Deliveries that overlap, out of date order, read as a stream in small batches, and one more after a restart."""
    from accountlens.streaming.incremental import stream_ingest
    inter = _inter(spark, sf)
    source, target = _scratch(spark, "deliveries"), _scratch(spark, "fact") + "/interactions"
    third = F.pmod(F.xxhash64("interaction_id"), F.lit(3))
    for part in (third != 2, third != 0):
        inter.filter(part).coalesce(2).write.mode("append").parquet(source)
        stream_ingest(spark, source, inter.schema, target, files_per_batch=2)
    inter.filter(third != 1).coalesce(2).write.mode("append").parquet(source)
    stream_ingest(spark, source, inter.schema, target)
    return spark.read.parquet(target)


@q("ext5_row_level_security", S.with_base() + "SELECT a.consultant_id, e.* FROM (SELECT DISTINCT consultant_id, employer_id "
   "FROM interactions WHERE consultant_id IS NOT NULL AND employer_id IS NOT NULL) a JOIN employers_raw e "
   "ON a.employer_id = e.employer_id")
def ext5(spark, sf):
    return rt.visible_employers(td.employers_raw(spark, sf), _inter(spark, sf))


@q("ext5_one_consultant", S.with_base() + "SELECT * FROM employers_raw WHERE employer_id IN (SELECT employer_id FROM "
   "interactions WHERE consultant_id = 'CONS007')")
def ext5_one(spark, sf):
    return rt.visible_employers(td.employers_raw(spark, sf), _inter(spark, sf), "CONS007")


# ---------------------------------------------------------------------------
# 2.1 sources, sinks, cleaning, audit (round trips through files Spark writes
# from the given tables, in the shared checkpoint folder)
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    return scratch_path(spark, name)


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


_INTER_TEXT_SQL = ("SELECT interaction_id, employer_id, CAST(interaction_date AS VARCHAR) AS interaction_date, interaction_type, "
                   "outcome, CAST(follow_up_required AS VARCHAR) AS follow_up_required, consultant_id FROM interactions")


@q("src1_csv_scan", S.with_base() + _INTER_TEXT_SQL)
def src1(spark, sf):
    from accountlens.sources.files import load_file
    path = _write_csv(_inter(spark, sf), _scratch(spark, "interactions") + "/interactions.csv")
    return load_file(spark, path)


@q("src1_csv_quoted_cells", "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents")
def src1_quoted(spark, sf):
    """Texts with quotes and line breaks written as CSV and read back."""
    from accountlens.sources.files import load_file, write_table
    docs = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "text", "lang", "source")
    path = write_table(docs, _scratch(spark, "documents") + "/documents.csv", "csv")
    return load_file(spark, path, multi_line=True)


@q("src1_csv_line_breaks", "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents")
def src1_line_breaks(spark, sf):
    """The same by the default load, which cuts the splits of each file into records."""
    from accountlens.sources.files import load_file, write_table
    docs = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "text", "lang", "source")
    return load_file(spark, write_table(docs, _scratch(spark, "documents") + "/documents.csv", "csv"))


@q("src2_parquet_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src2(spark, sf):
    from accountlens.sources.files import load_file
    return load_file(spark, f"{sf.rstrip('/')}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")


@q("src3_format_dispatch", S.with_base() + "SELECT employer_id, company_size, status FROM employers_raw")
def src3(spark, sf):
    from accountlens.sources.files import load_file
    path = _scratch(spark, "dispatch") + "/EMPLOYERS.CSV"
    _write_csv(td.employers_raw(spark, sf).select("employer_id", "company_size", "status"), path)
    return load_file(spark, path)


def _loader_employers(spark, sf, with_interactions: bool = False) -> tuple[DataFrame, str]:
    emp = _emp(spark, sf, with_revenue=False)
    emp = emp.withColumn("revenue_potential", seg.estimate_revenue_potential(emp))
    raw_dir = _scratch(spark, "raw")
    _write_csv(emp, raw_dir + "/employers.csv")
    if with_interactions:
        _write_csv(_inter(spark, sf), raw_dir + "/interactions.csv")
    return emp, raw_dir


_SRC4_SQL = (S.with_base(with_revenue=False) +
             f"SELECT employer_id, {_pseudo_sql('company_name')} AS company_name, company_size, sector, region, status, "
             f"CAST(last_contact_date AS VARCHAR) AS last_contact_date, frequency_12m, {_revenue_sql()} AS revenue_potential, "
             f"'{FIXED_STAMP}' AS gdpr_processed_at, true AS gdpr_pseudonymized FROM employers")


@q("src4_load_employers", _SRC4_SQL)
def src4(spark, sf):
    from accountlens.sources.loaders import DataLoader
    _, raw_dir = _loader_employers(spark, sf)
    return DataLoader(spark, raw_dir, salt=FIXED_SALT, processed_at=FIXED_STAMP).load_employers("employers.csv")


@q("src5_load_interactions", S.with_base() + _INTER_TEXT_SQL)
def src5(spark, sf):
    from accountlens.sources.loaders import DataLoader
    raw_dir = _scratch(spark, "raw")
    _write_csv(_inter(spark, sf), raw_dir + "/interactions.csv")
    return DataLoader(spark, raw_dir, salt=FIXED_SALT).load_interactions("interactions.csv")


@q("src6_bulk_load", S.with_base() + _INTER_TEXT_SQL)
def src6(spark, sf):
    from accountlens.sources.files import load_bulk
    inter = _inter(spark, sf)
    titled = inter.toDF(*[" " + c.replace("_", " ").title() + " " for c in inter.columns])
    redelivered = titled.unionByName(titled.filter(F.col(" Interaction Date ") >= F.lit(_dt.date(2000, 1, 1))))
    path = _write_csv(redelivered, _scratch(spark, "bulk") + "/interactions.csv")
    return load_bulk(spark, path)


@q("cln1_normalize_columns", S.with_base() + "SELECT employer_id, company_size, sector, status FROM employers_raw")
def cln1(spark, sf):
    from accountlens.sources.files import normalize_column_names
    emp = td.employers_raw(spark, sf).select(F.col("employer_id").alias(" Employer Id"),
                                             F.col("company_size").alias("Company Size "),
                                             F.col("sector").alias("SECTOR"), F.col("status").alias("Status"))
    return normalize_column_names(emp)


@q("cln2_drop_duplicates", S.with_base() + "SELECT DISTINCT employer_id, interaction_type FROM interactions")
def cln2(spark, sf):
    from accountlens.sources.files import drop_exact_duplicates
    return drop_exact_duplicates(_inter(spark, sf).select("employer_id", "interaction_type"))


_SPLIT = _dt.date(1998, 1, 1)


@q("uni1_union_frames", S.with_base() + "SELECT interaction_id, employer_id, interaction_date, CASE WHEN interaction_date >= "
   f"{td.sql_date(_SPLIT)} THEN outcome END AS outcome FROM interactions")
def uni1(spark, sf):
    from accountlens.sources.files import union_frames
    inter = _inter(spark, sf)
    early = inter.filter(F.col("interaction_date") < F.lit(_SPLIT)).select("interaction_id", "employer_id", "interaction_date")
    late = inter.filter((F.col("interaction_date") >= F.lit(_SPLIT)) | F.col("interaction_date").isNull()).select("interaction_id", "employer_id",
                                                                             "interaction_date", "outcome")
    return union_frames([early, late])


@q("snk1_write_segmented", S.with_base(*S.segmented_ctes()) + "SELECT employer_id, segment_name, priority_score FROM segmented")
def snk1(spark, sf):
    from accountlens.sources.files import write_segmented
    path = write_segmented(_fixed_segmented(spark, sf), _scratch(spark, "processed"), AS_OF, "parquet", drop_pii=True)
    return spark.read.parquet(path).select("employer_id", "segment_name", "priority_score")


@q("snk2_write_profiles", ORACLE["prf2_segment_report"])
def snk2(spark, sf):
    from accountlens.sources.files import write_profiles
    path = write_profiles(segment_profile_report(_fixed_segmented(spark, sf)), _scratch(spark, "processed"))
    schema = "segment_name string, count bigint, avg_rfm_score double, avg_priority_score double, avg_revenue_potential double"
    return spark.read.option("header", True).schema(schema).csv(path)


_AUDIT_SQL = (S.with_base() + "SELECT 'employers.csv' AS filename, 'employers' AS data_type, "
              "CAST((SELECT count(*) FROM employers_raw) AS BIGINT) AS row_count "
              "UNION ALL SELECT 'interactions.csv', 'interactions', CAST((SELECT count(*) FROM interactions) AS BIGINT)")


def _audited_loader(spark, sf):
    from accountlens.sources.loaders import DataLoader
    _, raw_dir = _loader_employers(spark, sf, with_interactions=True)
    loader = DataLoader(spark, raw_dir, salt=FIXED_SALT, processed_at=FIXED_STAMP)
    loader.load_employers("employers.csv")
    loader.load_interactions("interactions.csv")
    return loader


@q("aud1_audit_log", _AUDIT_SQL)
def aud1(spark, sf):
    return _audited_loader(spark, sf).audit.to_dataframe().select("filename", "data_type", "row_count")


@q("aud2_file_checksum")
def aud2(spark, sf):
    from accountlens.sources.audit import file_checksums
    return file_checksums(spark, f"{sf.rstrip('/')}/*.parquet")


@q("aud2_checksum_of_written_files", "SELECT c_nationkey, md5(string_agg(c_custkey || ',' || c_name, chr(10) ORDER BY c_custkey) "
   "|| chr(10)) AS checksum FROM customer GROUP BY c_nationkey")
def aud2_written(spark, sf):
    """One CSV file for each nation; every other one is streamed, as files too large for one value are."""
    from accountlens.sources.audit import file_checksums
    path = _scratch(spark, "nations")
    (spark.read.parquet(f"{sf.rstrip('/')}/customer.parquet").select("c_nationkey", "c_custkey", "c_name")
     .repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
     .write.partitionBy("c_nationkey").csv(path))
    files = path + "/*/*.csv"
    median = file_checksums(spark, files).agg(F.percentile("length", 0.5)).first()[0]
    return file_checksums(spark, files, whole_file_bytes=int(median or 0)).select(
        F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("c_nationkey"), "checksum")


_RUN_SOURCE = f"priced AS (SELECT e.*, {_revenue_sql()} AS revenue_potential FROM employers e)"


@q("batch_run", S.with_base(_RUN_SOURCE, *S.kmeans_ctes(START_CENTRES, LLOYD_STEPS, "priced"), with_revenue=False) +
   f"SELECT employer_id, {_pseudo_sql('company_name')} AS company_name, segment_name, priority_score FROM segmented")
def batch_run(spark, sf):
    """The end-to-end run (load, checks, gate, segments, profiles, audit) and the table that it writes."""
    from accountlens.plans.batch import run_pipeline
    _, raw_dir = _loader_employers(spark, sf, with_interactions=True)
    done = run_pipeline(spark, raw_dir, _scratch(spark, "processed"), AS_OF, salt=FIXED_SALT, run_date=AS_OF,
                        segmenter_params=_FIXED_FIT)
    return spark.read.parquet(done["segmented"]).select("employer_id", "company_name", "segment_name", "priority_score")


@q("snk3_audit_sink", _AUDIT_SQL)
def snk3(spark, sf):
    loader = _audited_loader(spark, sf)
    path = loader.audit.save(_scratch(spark, "processed"))
    return spark.read.option("header", True).schema(
        "timestamp string, filename string, data_type string, row_count bigint, checksum string").csv(path).select(
        "filename", "data_type", "row_count")
