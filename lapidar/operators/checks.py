"""Integrity checks as rows (tabela, verificacao, medida, passou)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.operators.scd2 import ACTIVE, END, START


class IntegrityError(Exception):
    """A table does not hold what its checks demand."""


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("linhas")).filter("linhas > 1")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (coluna, nulos) for all columns from one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("nulos")) for c in columns]
            )
        )
    )


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (etapa, linhas), one per frame."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("etapa"), "linhas")
            for n, df in stages.items()
        ],
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (coluna, distintos), exact.

    One aggregation per column: several distinct counts in one would copy every row
    once per column before the shuffle.
    """
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.countDistinct(c).alias("distintos")).select(F.lit(c).alias("coluna"), "distintos")
            for c in columns
        ],
    )


def single_active(dim: DataFrame | None, key: str) -> DataFrame:
    """One row: keys with more than one active version, and whether there are none.

    A table that does not exist (None) has no such key.
    """
    if dim is None:
        return SparkSession.active().sql("SELECT 0L AS chaves_repetidas, true AS passou")
    many = duplicate_keys(dim.filter(F.col(ACTIVE)), key)
    return many.agg(F.count(F.lit(1)).alias("chaves_repetidas")).withColumn(
        "passou", F.col("chaves_repetidas") == 0
    )


def dimension_scd2(
    dim: DataFrame | None, table: str, key: str, required: Sequence[str] | None = None
) -> DataFrame:
    """The SCD2 invariants of a dimension; ``dim`` is None when the table does not exist.

    All counts come from one aggregation per key followed by one over the keys, so the
    table is read once and only per-key partial counts are shuffled.
    """
    exists = ("tabela_existe", F.lit(int(dim is not None)), F.lit(dim is not None))
    if dim is None:
        return _check_rows(SparkSession.active().range(1), table, [exists])
    missing = [c for c in (ACTIVE, START, END) if c not in dim.columns]
    required = [c for c in (required or [key, ACTIVE, START]) if c in dim.columns]
    per_key = [F.count(F.lit(1)).alias("n")]
    total = [F.coalesce(F.sum("n"), F.lit(0)).alias("linhas")]
    # The checks' names are report values.
    checks = [
        exists,
        ("tabela_nao_vazia", F.col("linhas"), F.col("linhas") > 0),
        ("colunas_scd2_presentes", F.lit(len(missing)), F.lit(not missing)),
    ]

    def zero(name: str, count: Column, counted_over_keys: Column) -> None:
        per_key.append(count.alias(name))
        total.append(F.coalesce(counted_over_keys, F.lit(0)).alias(name))
        checks.append((name, F.col(name), F.col(name) == 0))

    if not missing:
        active, ended = F.col(ACTIVE), F.col(END).isNotNull()
        zero(
            "unicidade_registro_ativo_por_chave",
            F.count_if(active),
            F.count_if(F.col("unicidade_registro_ativo_por_chave") > 1),
        )
        zero("ativos_sem_data_fim", F.count_if(active & ended), F.sum("ativos_sem_data_fim"))
        zero("inativos_com_data_fim", F.count_if(~active & ~ended), F.sum("inativos_com_data_fim"))
    for c in required:
        zero(f"sem_nulos_em_{c}", F.count_if(F.col(c).isNull()), F.sum(f"sem_nulos_em_{c}"))

    return _check_rows(dim.groupBy(key).agg(*per_key).agg(*total), table, checks)


def surrogate_key_check(dim: DataFrame, table: str, surrogate: str) -> DataFrame:
    """Rows, NULL surrogate keys and surrogate keys that occur more than once."""
    per_key = dim.groupBy(surrogate).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum(F.when(F.col(surrogate).isNull(), F.col("n"))), F.lit(0)).alias("nulas"),
        F.count_if(F.col("n") > 1).alias("repetidas"),
    )
    checks = [
        ("registros", F.col("linhas"), F.col("linhas") > 0),
        ("sk_nulas", F.col("nulas"), F.col("nulas") == 0),
        ("sk_duplicadas", F.col("repetidas"), F.col("repetidas") == 0),
    ]
    return _check_rows(totals, table, checks)


def initial_load(dim: DataFrame, table: str, key: str, surrogate: str) -> DataFrame:
    """A freshly loaded dimension: the SCD2 invariants plus a valid surrogate key."""
    return dimension_scd2(dim, table, key, [ACTIVE]).unionByName(
        surrogate_key_check(dim, table, surrogate)
    )


def fact_quality(fact: DataFrame, table: str = "fato_vendas") -> DataFrame:
    """Not empty, one row per item, positive totals, client and product resolved."""
    per_item = fact.groupBy("id_item").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("valor_total_item").isNull() | (F.col("valor_total_item") <= 0)).alias("invalidos"),
        F.count_if(F.col("sk_cliente").isNull()).alias("sem_cliente"),
        F.count_if(F.col("sk_produto").isNull()).alias("sem_produto"),
    )
    totals = per_item.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
        F.count_if(F.col("n") > 1).alias("repetidos"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("invalidos", "sem_cliente", "sem_produto")
        ],
    )
    checks = [
        ("tabela_nao_vazia", F.col("linhas"), F.col("linhas") > 0),
        ("id_item_unico", F.col("repetidos"), F.col("repetidos") == 0),
        ("valor_total_item_positivo", F.col("invalidos"), F.col("invalidos") == 0),
        ("sk_cliente_preenchida", F.col("sem_cliente"), F.col("sem_cliente") == 0),
        ("sk_produto_preenchida", F.col("sem_produto"), F.col("sem_produto") == 0),
    ]
    return _check_rows(totals, table, checks)


def require_passed(checks: DataFrame) -> None:
    """Raise with the names of the failed checks; the rows are few, one per check."""
    failed = [r["verificacao"] for r in checks.filter(~F.col("passou")).collect()]
    if failed:
        raise IntegrityError(f"failed checks: {sorted(failed)}")


def _check_rows(
    totals: DataFrame, table: str, checks: Sequence[tuple[str, Column, Column]]
) -> DataFrame:
    rows = [
        F.struct(
            F.lit(table).alias("tabela"),
            F.lit(name).alias("verificacao"),
            measure.cast("bigint").alias("medida"),
            passed.alias("passou"),
        )
        for name, measure, passed in checks
    ]
    return totals.select(F.inline(F.array(*rows)))
