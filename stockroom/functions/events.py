"""Column expressions for event rows (all built-in functions, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockroom import schemas as S


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sign_error(event_type: Column | str, quantity: Column | str) -> Column:
    """P4 error text: zero is refused for every type, negative for inflow/outflow types."""
    et, q = _c(event_type), _c(quantity)
    must_be_positive = F.concat(et, F.lit(S.MSG_MUST_BE_POSITIVE))
    return (
        F.when(q == 0, F.lit(S.MSG_ZERO_QUANTITY))
        .when(et.isin(*S.INFLOW_TYPES, *S.OUTFLOW_TYPES) & (q < 0), must_be_positive)
        .when(~et.isin(*S.EVENT_TYPES), F.lit(S.MSG_UNSUPPORTED_TYPE))
    )


def signed_quantity(event_type: Column | str, quantity: Column | str) -> Column:
    """P4 signed delta; NULL where the sign rule refuses the row."""
    et, q = _c(event_type), _c(quantity)
    delta = F.when(et.isin(*S.OUTFLOW_TYPES), -q).otherwise(q)
    return F.when(sign_error(et, q).isNull(), delta.cast("int"))


def valid_signed_event(event_type: Column | str, quantity: Column | str) -> Column:
    return sign_error(event_type, quantity).isNull()


def is_guarded(event_type: Column | str) -> Column:
    """Types whose acceptance is refused when they would drive stock below zero."""
    return _c(event_type).isin(*S.OUTFLOW_TYPES)


def date_id(ts: Column | str) -> Column:
    """``YYYY-MM-DD`` text of a UTC timestamp."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def partition_parts(ts: Column | str) -> list[Column]:
    """Zero-padded year / month / day texts used as lake partition values."""
    t = _c(ts)
    return [
        F.date_format(t, "yyyy").alias("year"),
        F.date_format(t, "MM").alias("month"),
        F.date_format(t, "dd").alias("day"),
    ]


def half_even(x: Column | str, places: int = 0) -> Column:
    """Python-style ``round`` (banker's rounding) on a decimal reading of the value."""
    return F.bround(_c(x), places)
