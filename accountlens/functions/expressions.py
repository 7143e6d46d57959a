"""Column-expression helpers.

All helpers return native Catalyst expressions, so they stay inside
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountlens import constants as C


def as_date_lit(value) -> Column:
    """A date literal from a ``datetime.date`` / ISO string."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def round_half_even(col: Column | str, digits: int) -> Column:
    """NumPy-style rounding: ``rint(x * 10^d) / 10^d`` (ties to even on the scaled value).

    ``F.round`` is half-up and ``F.bround`` rounds the decimal text of the double,
    both differ from the binary-scaled rounding used by the documented behaviour.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def safe_divide(num: Column, den: Column, alternate=None) -> Column:
    """``DIVIDE(num, den, alternate)``: the alternate when the denominator is 0 or null."""
    alt = F.lit(alternate).cast("double") if alternate is not None else F.lit(None).cast("double")
    return F.when(den.isNull() | (den == 0), alt).otherwise(F.try_divide(num.cast("double"), den.cast("double")))


def clip(col: Column, lower: float, upper: float) -> Column:
    """Clip into [lower, upper] keeping null as null (``greatest``/``least`` skip nulls)."""
    return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(col, F.lit(float(lower))), F.lit(float(upper))))


def nan_to_null(col: Column) -> Column:
    """NaN sorts above every number in Spark; treat it as missing instead."""
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col.cast("double"))


def in_set_strict(col: Column, values) -> Column:
    """True only for non-null values in the set (quality-check semantics: null fails)."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def pseudonym(col: Column, salt: str) -> Column:
    """``'anon_' + sha256(salt + ':' + value)[:16]``; null stays null."""
    digest = F.sha2(F.concat(F.lit(salt), F.lit(":"), col.cast("string")), 256)
    return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(C.PSEUDONYM_PREFIX), F.substring(digest, 1, C.PSEUDONYM_HEX_CHARS)))


def to_timestamp_lenient(col: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Parse to timestamp, malformed or null -> null (quality checks never fail on them)."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp")
    if fmt:
        return F.try_to_timestamp(col.cast("string"), F.lit(fmt))
    return F.try_to_timestamp(col.cast("string"))


def whole_days_since(df: DataFrame, column: str, as_of) -> Column:
    """``floor(as_of - value)`` in whole days, for date, timestamp or ISO-text columns.

    Dates use ``datediff``; timestamps use a floored micro-second difference
    (``datediff`` would count calendar days, ``timestampdiff`` truncates toward 0).
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    end = as_date_lit(as_of)
    if isinstance(dtype, T.DateType):
        return F.datediff(end, c).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = c
    else:
        ts = F.to_timestamp(c.cast("string"))
    if isinstance(dtype, T.TimestampNTZType):
        end_ts = end.cast("timestamp_ntz")
    else:
        end_ts = end.cast("timestamp")
    micros = F.unix_micros(end_ts.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def in_months_window(date_col: Column, end, months: int) -> Column:
    """``DATESINPERIOD(end, -n, MONTH)``: half-open ``(add_months(end, -n), end]``."""
    end_c = as_date_lit(end)
    d = date_col.cast("date")
    return (d > F.add_months(end_c, -months)) & (d <= end_c)
