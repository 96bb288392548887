"""Keys, tolerant casts, null-safe comparison and guarded ratios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType

# An integer written with a fraction ("7.0", as tools that store nullable integers
# as floats export them); the fraction is cut off.
_INTEGRAL_PART = r"^\s*([+-]?\d+)\.\d*\s*$"


def surrogate_key(key: str | Column) -> Column:
    """32 hex characters that depend on the business key only: all versions share it."""
    return F.md5(_column(key).cast("string"))


def version_key(key: str | Column, start: str | Column) -> Column:
    """Key of one version: business key plus the start of its validity."""
    start_text = F.date_format(_column(start), "yyyy-MM-dd HH:mm:ss")
    return F.md5(F.concat_ws("|", _column(key).cast("string"), start_text))


def is_blank(value: str | Column) -> Column:
    value = _column(value)
    return value.isNull() | (F.trim(value) == "")


def tolerant_cast(value: str | Column, dtype: DataType) -> Column:
    """Cast text to ``dtype``; NULL where the text does not fit. Strings are trimmed."""
    value = _column(value)
    if isinstance(dtype, StringType):
        return F.trim(value)
    if isinstance(dtype, (IntegerType, LongType)):
        # the regular expression runs only for values the plain cast rejects
        return F.coalesce(
            value.try_cast(dtype),
            F.regexp_extract(value, _INTEGRAL_PART, 1).try_cast(dtype),
        )
    return value.try_cast(dtype)


def differs(columns: Sequence[str], old: str, new: str) -> Column:
    """True where any column differs between structs ``old`` and ``new``; NULL equals NULL."""
    return reduce(or_, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns])


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; 0 when the denominator is 0 or either is NULL."""
    return F.coalesce(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0)
    )


def month_start(value: str | Column) -> Column:
    return F.date_trunc("month", _column(value))


def at(batch_ts: str) -> Column:
    """The batch time as a literal, so one run stamps one instant everywhere."""
    return F.lit(batch_ts).cast("timestamp")


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
