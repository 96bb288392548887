"""Typing of text columns and a report of the values lost on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lapidar.functions.expressions import is_blank, tolerant_cast


def typed_cast(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns of ``schema``; other columns pass through."""
    types = {f.name: f.dataType for f in schema}
    return df.select(
        *[tolerant_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def cast_loss_counts(schema: StructType) -> list[Column]:
    """Per non-text column: values that are not blank before and NULL after the cast."""
    return [
        F.count_if(~is_blank(f.name) & tolerant_cast(f.name, f.dataType).isNull()).alias(f.name)
        for f in schema
        if not isinstance(f.dataType, StringType)
    ]


def cast_loss_report(raw: DataFrame, schema: StructType) -> DataFrame:
    """Rows (coluna, tipo, perdidos), from one pass over the raw rows."""
    types = {f.name: f.dataType.simpleString() for f in schema}
    counts = raw.agg(*cast_loss_counts(schema))
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("coluna"),
                        F.lit(types[c]).alias("tipo"),
                        F.col(c).alias("perdidos"),
                    )
                    for c in counts.columns
                ]
            )
        )
    )
