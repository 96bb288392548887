"""Hash texts in half their bytes, for rows that are about to be shuffled.

32 lower-case hex digits become the 16 bytes they stand for; any other text stays as it is, one
of 16 bytes or more with a zero byte behind it, so that the length tells the two apart.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def shortened(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns, where they are text, as short bytes; columns of other types stay."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: _short(F.col(c)) for c in texts}) if texts else df


def restored(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The exact texts of columns that ``shortened`` made."""
    shorts = [c for c in columns if isinstance(df.schema[c].dataType, BinaryType)]
    return df.withColumns({c: _text(F.col(c)) for c in shorts}) if shorts else df


def _short(text: Column) -> Column:
    size, plain = F.octet_length(text), text.cast("binary")
    is_hash = (size == 32) & F.coalesce(F.lower(F.hex(F.unhex(text))) == text, F.lit(False))
    return F.when(is_hash, F.unhex(text)).when(size >= 16, F.concat(plain, F.unhex(F.lit("00")))).otherwise(plain)


def _text(short: Column) -> Column:
    size = F.octet_length(short)
    return (
        F.when(size == 16, F.lower(F.hex(short)))
        .when(size > 16, F.substring(short, F.lit(1), size - 1).cast("string"))
        .otherwise(short.cast("string"))
    )
