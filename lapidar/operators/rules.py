"""Quality rules: rows to keep and columns to normalise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``keep`` decides per row; ``fixes`` replaces columns. NULL counts as not kept."""

    keep: Column | None = None
    fixes: dict[str, Column] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        if self.keep is not None:
            df = df.filter(self.keep)
        return df.withColumns(self.fixes) if self.fixes else df


def not_null(*columns: str) -> Rule:
    return Rule(keep=_all([F.col(c).isNotNull() for c in columns]))


def in_set(column: str, values: Sequence[str]) -> Rule:
    return Rule(keep=F.col(column).isin(*values))


def positive(*columns: str) -> Rule:
    return Rule(keep=_all([F.col(c) > 0 for c in columns]))


def normalized(column: str) -> Rule:
    """Trimmed and upper-cased."""
    return Rule(fixes={column: F.upper(F.trim(column))})


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def table_rules() -> dict[str, Rule]:
    """Rules of the retail tables; a table without an entry passes through."""
    return {
        "clientes": not_null("cpf", "email"),
        "pedidos": in_set("status_pedido", ORDER_STATUS),
        "itens_pedido": positive("quantidade", "preco_unitario"),
        "pagamentos_pedido": positive("valor_pago"),
        "lojas": normalized("estado_loja"),
        "enderecos": normalized("estado"),
    }


# The order states the source system knows.
COMPLETED = "Concluído"
ORDER_STATUS = (COMPLETED, "Pendente", "Cancelado")


def apply_table_rule(df: DataFrame, table: str) -> DataFrame:
    rule = table_rules().get(table)
    return rule.apply(df) if rule else df


def discard_counts(table: str, key: str) -> list[Column]:
    """Row counts over typed rows: read, without key, against a rule, valid."""
    rule = table_rules().get(table)
    keep = rule.keep if rule and rule.keep is not None else F.lit(True)
    has_key = F.col(key).isNotNull()
    kept = F.coalesce(keep, F.lit(False))
    return [
        F.count(F.lit(1)).alias("lidas"),
        F.count_if(~has_key).alias("sem_chave"),
        F.count_if(has_key & ~kept).alias("contra_regra"),
        F.count_if(has_key & kept).alias("validas"),
    ]


def quality_discard_report(typed: DataFrame, table: str, key: str) -> DataFrame:
    """One row with the counts of ``discard_counts`` plus the rows dropped in total."""
    return typed.agg(*discard_counts(table, key)).select(
        F.lit(table).alias("tabela"),
        "*",
        (F.col("sem_chave") + F.col("contra_regra")).alias("descartadas"),
    )


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
