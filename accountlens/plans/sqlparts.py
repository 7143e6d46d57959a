"""SQL (DuckDB) building blocks for the oracle forms of the catalogued queries.

These are independent formulations of the same semantics, written in plain
SQL over the driver's tables; they are never executed by this library.
"""

from __future__ import annotations

from accountlens import constants as C
from accountlens.sources.testdata import AS_OF, sql_ctes, sql_date


def rne(expr: str, digits: int) -> str:
    """NumPy-style rounding in SQL: round the scaled value to an integer, ties to even."""
    scale = 10 ** digits
    return f"(round_even(({expr}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE)"


def dbl(x) -> str:
    return f"{float(x)!r}::DOUBLE"


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def with_base(*extra_ctes: str, with_revenue: bool = True) -> str:
    body = sql_ctes(AS_OF, with_revenue)
    if extra_ctes:
        body += ",\n" + ",\n".join(extra_ctes)
    return "WITH " + body + "\n"


ASOF = sql_date(AS_OF)


def scaled(col: str, lo: str, hi: str) -> str:
    return (f"CASE WHEN {hi} = {lo} THEN (CASE WHEN {col} IS NOT NULL THEN 0.0::DOUBLE END) "
            f"ELSE (CAST({col} AS DOUBLE) - CAST({lo} AS DOUBLE)) / (CAST({hi} AS DOUBLE) - CAST({lo} AS DOUBLE)) END")


def segment_case(pos: int) -> str:
    parts = " ".join(f"WHEN {s[0]} THEN {repr(s[pos]) if isinstance(s[pos], int) else _q(s[pos])}" for s in C.SEGMENTS)
    return f"CASE segment_id {parts} END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rfm_ctes(source: str = "employers") -> list[str]:
    """recency, min-max scores and rfm_score over ``source`` (ctes rfm, rfm_stats, scored)."""
    w = C.RFM_WEIGHTS
    return [
        f"rfm AS (SELECT s.*, CAST(date_diff('day', s.last_contact_date, {ASOF}) AS BIGINT) AS recency_days FROM {source} s)",
        "rfm_stats AS (SELECT min(recency_days) AS rlo, max(recency_days) AS rhi, min(frequency_12m) AS flo, "
        "max(frequency_12m) AS fhi, min(CASE WHEN isnan(revenue_potential) THEN NULL ELSE revenue_potential END) AS mlo, "
        "max(CASE WHEN isnan(revenue_potential) THEN NULL ELSE revenue_potential END) AS mhi FROM rfm)",
        "scored0 AS (SELECT r.*, "
        f"1.0::DOUBLE - ({scaled('r.recency_days', 'st.rlo', 'st.rhi')}) AS r_score, "
        f"{scaled('r.frequency_12m', 'st.flo', 'st.fhi')} AS f_score, "
        f"{scaled('r.revenue_potential', 'st.mlo', 'st.mhi')} AS m_score FROM rfm r, rfm_stats st)",
        f"scored AS (SELECT *, {rne(f'r_score * {dbl(w['r'])} + f_score * {dbl(w['f'])} + m_score * {dbl(w['m'])}', 4)} "
        "AS rfm_score FROM scored0)",
    ]


def clip_sql(expr: str, lo: float, hi: float) -> str:
    """Clip keeping null as null (``least``/``greatest`` skip nulls)."""
    return f"(CASE WHEN ({expr}) IS NULL THEN NULL ELSE least(greatest({expr}, {dbl(lo)}), {dbl(hi)}) END)"


def priority_sql() -> str:
    w = C.PRIORITY_WEIGHTS
    raw = (f"(1.0::DOUBLE - rfm_score) * {dbl(w['rfm'])} + "
           f"{clip_sql(f'CAST(recency_days AS DOUBLE) / {dbl(C.PRIORITY_RECENCY_DAYS)}', 0, 1)} * {dbl(w['recency'])} + "
           f"(1.0::DOUBLE - f_score) * {dbl(w['frequency'])}")
    return rne(f"{clip_sql(raw, 0, 1)} * 100.0::DOUBLE", 1)


def segmented_ctes(source: str = "employers") -> list[str]:
    """Segments from the fixed cluster ``employer key % 4`` (ctes ... clustered, ranks, segmented)."""
    return rfm_ctes(source) + [
        "clustered AS (SELECT *, CAST(CAST(employer_id AS BIGINT) % 4 AS INTEGER) AS cluster FROM scored)",
        "ranks AS (SELECT cluster, CAST(row_number() OVER (ORDER BY avg(rfm_score) DESC, cluster) - 1 AS INTEGER) "
        "AS segment_id FROM clustered WHERE cluster IS NOT NULL GROUP BY cluster)",
        "segmented0 AS (SELECT c.*, k.segment_id FROM clustered c LEFT JOIN ranks k ON c.cluster = k.cluster)",
        f"segmented AS (SELECT *, {segment_case(1)} AS segment_name, CAST({segment_case(3)} AS INTEGER) AS segment_priority, "
        f"{segment_case(4)} AS segment_action, {priority_sql()} AS priority_score FROM segmented0)",
    ]


def kmeans_ctes(start, steps: int, source: str = "employers") -> list[str]:
    """Segments from ``steps`` unrolled Lloyd steps from the centres ``start`` (ctes ... clustered, ranks, segmented)."""
    rows = ", ".join(f"({k}, {', '.join(dbl(x) for x in c)})" for k, c in enumerate(start))
    ctes = rfm_ctes(source) + [
        "points AS (SELECT employer_id, r_score, f_score, m_score FROM scored WHERE recency_days IS NOT NULL "
        "AND frequency_12m IS NOT NULL AND revenue_potential IS NOT NULL AND NOT isnan(revenue_potential))",
        f"centres0 AS (SELECT * FROM (VALUES {rows}) t(k, r, f, m))"]
    distance = " + ".join(f"(p.{c}_score - c.{c}) * (p.{c}_score - c.{c})" for c in "rfm")
    for i in range(steps + 1):
        ctes.append(f"nearest{i} AS (SELECT p.*, c.k FROM points p, centres{i} c QUALIFY row_number() OVER "
                    f"(PARTITION BY p.employer_id ORDER BY {distance}, c.k) = 1)")
        if i < steps:
            ctes.append(f"centres{i + 1} AS (SELECT c.k, " + ", ".join(
                f"coalesce(avg(n.{x}_score), any_value(c.{x})) AS {x}" for x in "rfm")
                + f" FROM centres{i} c LEFT JOIN nearest{i} n ON n.k = c.k GROUP BY c.k)")
    ctes.append(f"clustered AS (SELECT s.*, CAST(n.k AS INTEGER) AS cluster FROM scored s LEFT JOIN nearest{steps} n "
                "ON s.employer_id = n.employer_id)")
    return ctes + segmented_ctes(source)[5:]


def dirty_employers_cte(source: str = "employers") -> str:
    """Injected faults, keyed on the customer key (identical to the Spark form)."""
    k = "CAST(employer_id AS BIGINT)"
    return f"""dirty_employers AS (
  SELECT CASE WHEN {k} % 97 = 1 THEN NULL WHEN {k} % 89 = 2 THEN CAST({k} - 1 AS VARCHAR) ELSE employer_id END AS employer_id,
         company_name,
         CASE WHEN {k} % 83 = 3 THEN 'giant' ELSE company_size END AS company_size,
         CASE WHEN {k} % 67 = 7 THEN 'mining' ELSE sector END AS sector,
         region,
         CASE WHEN {k} % 79 = 4 THEN 'Unknown' ELSE status END AS status,
         revenue_potential,
         CASE WHEN {k} % 71 = 6 THEN NULL WHEN {k} % 73 = 5 THEN CAST(last_contact_date + INTERVAL 10 YEAR AS DATE)
              ELSE last_contact_date END AS last_contact_date,
         frequency_12m
  FROM {source})"""


def dirty_interactions_cte(source: str = "interactions") -> str:
    k = "CAST(interaction_id AS BIGINT)"
    return f"""dirty_interactions AS (
  SELECT CASE WHEN {k} % 997 = 1 THEN NULL WHEN {k} % 991 = 2 THEN CAST({k} - 1 AS VARCHAR) ELSE interaction_id END AS interaction_id,
         CASE WHEN {k} % 971 = 5 THEN NULL WHEN {k} % 953 = 8 THEN 'X' || employer_id ELSE employer_id END AS employer_id,
         CASE WHEN {k} % 967 = 6 THEN NULL WHEN {k} % 961 = 7 THEN CAST(interaction_date + INTERVAL 20 YEAR AS DATE)
              ELSE interaction_date END AS interaction_date,
         CASE WHEN {k} % 983 = 3 THEN 'carrier_pigeon' ELSE interaction_type END AS interaction_type,
         CASE WHEN {k} % 977 = 4 THEN 'maybe' ELSE outcome END AS outcome,
         follow_up_required, consultant_id
  FROM {source})"""
