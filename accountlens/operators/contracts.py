"""Table contracts (CON1-CON8): required columns, coercion, nulls, uniqueness, value sets, bounds.

All row-local rules of a contract are counted in one aggregation; each unique
key adds one ``groupBy`` (map-side partial counts, so a hot key costs one row
per partition in the shuffle). Modes: ``raise`` (collect every violation, then
raise once), ``report`` (violations DataFrame) and ``quarantine`` (good, bad).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountlens import constants as C


class ContractError(ValueError):
    """Raised with every violation of a contract listed."""


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str                      # 'string' | 'double' | 'long'
    nullable: bool = True
    unique: bool = False
    isin: tuple | None = None
    greater_than: float | None = None
    greater_equal: float | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple = field(default_factory=tuple)

    def column(self, name: str) -> ColumnRule:
        return next(c for c in self.columns if c.name == name)


# CON1
EMPLOYER_CONTRACT = Contract("employers", (
    ColumnRule("employer_id", "string", nullable=False, unique=True),
    ColumnRule("company_size", "string", nullable=False, isin=tuple(C.VALID_SIZES)),
    ColumnRule("status", "string", nullable=False, isin=tuple(C.VALID_STATUSES)),
    ColumnRule("sector", "string", nullable=True, isin=tuple(C.VALID_SECTORS)),
    ColumnRule("revenue_potential", "double", nullable=True, greater_than=0),
    ColumnRule("last_contact_date", "string", nullable=True),
    ColumnRule("frequency_12m", "long", nullable=True, greater_equal=0),
))

# CON2
INTERACTION_CONTRACT = Contract("interactions", (
    ColumnRule("interaction_id", "string", nullable=False, unique=True),
    ColumnRule("employer_id", "string", nullable=False),
    ColumnRule("interaction_date", "string", nullable=False),
    ColumnRule("interaction_type", "string", nullable=True, isin=tuple(C.VALID_INTERACTION_TYPES)),
    ColumnRule("outcome", "string", nullable=True, isin=tuple(C.VALID_OUTCOMES)),
))


def coerce(col: Column, source: T.DataType, dtype: str) -> Column:
    """CON4: cast to the contract type; failures become null (and are counted)."""
    if dtype == "string":
        if isinstance(source, T.DateType):
            return F.date_format(col, "yyyy-MM-dd")
        return col.cast("string")
    if dtype == "double":
        return col.try_cast("double") if isinstance(source, T.StringType) else col.cast("double")
    if dtype == "long":
        if isinstance(source, T.IntegralType):
            return col.cast("long")
        # '5.0' is a valid integer once a null was present; a fractional part is not. Text never passes through
        # a double, which would change integers beyond 2 ** 53
        if isinstance(source, T.StringType):
            exact = col.try_cast("decimal(38,10)")
            return F.coalesce(col.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint")))
        d = col.try_cast("double") if isinstance(source, T.StringType) else col.cast("double")
        return F.when(d.isNotNull() & ~F.isnan(d) & (d == F.floor(d)), d.cast("long"))
    raise ValueError(f"unsupported contract type {dtype}")


def _row_rules(df: DataFrame, contract: Contract):
    """(column, check, failure-condition) for every row-local rule of columns present."""
    rules = []
    for rule in contract.columns:
        if rule.name not in df.columns:
            continue
        src = F.col(rule.name)
        typed = coerce(src, df.schema[rule.name].dataType, rule.dtype)
        if rule.dtype != "string":
            rules.append((rule.name, f"coerce_{rule.dtype}", src.isNotNull() & typed.isNull()))
            if rule.dtype == "double":
                typed = F.when(~F.isnan(typed), typed)
        if not rule.nullable:
            rules.append((rule.name, "not_nullable", src.isNull()))
        if rule.isin is not None:
            rules.append((rule.name, "isin", typed.isNotNull() & ~typed.isin(list(rule.isin))))
        if rule.greater_than is not None:
            rules.append((rule.name, f"greater_than({rule.greater_than:g})", typed <= F.lit(rule.greater_than)))
        if rule.greater_equal is not None:
            rules.append((rule.name, f"greater_than_or_equal_to({rule.greater_equal:g})",
                          typed < F.lit(rule.greater_equal)))
    return rules


def violations(df: DataFrame, contract: Contract, with_row_count: bool = False) -> DataFrame:
    """CON3-CON8 as a report: (column_name, check_name, failed_rows) for every rule, lazily.

    ``with_row_count`` adds a ('*', 'row_count', n) row computed by the same aggregation.
    """
    spark = df.sparkSession
    schema = "column_name string, check_name string, failed_rows bigint"
    parts = []
    missing = [r.name for r in contract.columns if r.name not in df.columns]
    if missing:
        parts.append(spark.createDataFrame([(m, "column_in_dataframe", None) for m in missing], schema))
    rules = _row_rules(df, contract)
    if with_row_count:
        rules = rules + [("*", "row_count", F.lit(True))]
    if rules:
        agg = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, _, cond) in enumerate(rules)])
        structs = [F.struct(F.lit(c).alias("column_name"), F.lit(chk).alias("check_name"),
                            F.col(f"r{i}").cast("long").alias("failed_rows"))
                   for i, (c, chk, _) in enumerate(rules)]
        parts.append(agg.select(F.inline(F.array(*structs))))
    for rule in contract.columns:
        if rule.unique and rule.name in df.columns:
            dup = (df.groupBy(rule.name).agg(F.count(F.lit(1)).alias("n"))
                   .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("failed_rows")))
            parts.append(dup.select(F.lit(rule.name).alias("column_name"), F.lit("unique").alias("check_name"),
                                    "failed_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coerced(df: DataFrame, contract: Contract) -> DataFrame:
    """The frame with every declared column cast to its contract type (extra columns kept)."""
    casts = {r.name: coerce(F.col(r.name), df.schema[r.name].dataType, r.dtype)
             for r in contract.columns if r.name in df.columns}
    return df.withColumns(casts) if casts else df


def validate_contract(df: DataFrame, contract: Contract, mode: str = "raise"):
    """Check a contract.

    * ``raise``: collect every violation (a handful of rows), raise ``ContractError`` once, else
      return the coerced frame;
    * ``report``: return the violations DataFrame;
    * ``quarantine``: return ``(good, bad)`` split on the row-local rules; unique keys are
      checked with a window-free semi/anti join on the duplicate keys.
    """
    if mode == "report":
        return violations(df, contract)
    if mode == "raise":
        rows = violations(df, contract).filter("failed_rows IS NULL OR failed_rows > 0").collect()
        if rows:
            lines = [f"{r['column_name']}: {r['check_name']} ({r['failed_rows'] if r['failed_rows'] is not None else 'missing'})"
                     for r in rows]
            raise ContractError(f"contract '{contract.name}' failed:\n  " + "\n  ".join(lines))
        return coerced(df, contract)
    if mode == "quarantine":
        missing = [r.name for r in contract.columns if r.name not in df.columns]
        if missing:
            raise ContractError(f"contract '{contract.name}': missing columns {missing}")
        bad_row = None
        for _, _, cond in _row_rules(df, contract):
            c = F.coalesce(cond, F.lit(False))
            bad_row = c if bad_row is None else bad_row | c
        flagged = df.withColumn("__bad", bad_row if bad_row is not None else F.lit(False))
        for rule in contract.columns:
            if rule.unique:
                key = F.col(rule.name)
                # null keys need no join: whether there are several is one count, and they may be a third of the rows
                nulls = df.filter(key.isNull()).limit(2).count() if rule.nullable else 0
                dups = (df.filter(key.isNotNull()).groupBy(key.alias("__dupkey")).agg(F.count(F.lit(1)).alias("__n"))
                        .filter("__n > 1").select("__dupkey", F.lit(True).alias("__dup")))
                keyed = flagged.filter(key.isNotNull())
                keyed = (keyed.join(dups, keyed[rule.name] == dups["__dupkey"], "left")
                         .withColumn("__bad", F.col("__bad") | F.coalesce(F.col("__dup"), F.lit(False)))
                         .drop("__dupkey", "__dup"))
                without = flagged.filter(key.isNull())
                flagged = keyed.unionByName(without.withColumn("__bad", F.lit(True)) if nulls > 1 else without)
        good = coerced(flagged.filter(~F.col("__bad")).drop("__bad"), contract)
        bad = flagged.filter(F.col("__bad")).drop("__bad")
        return good, bad
    raise ValueError("mode must be 'raise', 'report' or 'quarantine'")
