"""Type 2 slowly changing dimensions.

A version is active exactly when ``registro_ativo`` is true and ``data_fim_vigencia``
is NULL. Validity is half-open: a version ends at the instant its successor starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.functions.expressions import at, differs

# Column names of the gold layer, the start of the first version and
# the names of the three change classes.
START = "data_inicio_vigencia"
END = "data_fim_vigencia"
ACTIVE = "registro_ativo"
STAMP = "_gold_processed_at"
CONTROL_COLUMNS = (START, END, ACTIVE, STAMP)
BEGINNING = "1900-01-01 00:00:00"
NEW, CHANGED, UNCHANGED = "novo", "alterado", "sem_alteracao"
CHANGE = "mudanca"


def open_versions(rows: DataFrame, start: str, batch_ts: str) -> DataFrame:
    """Rows as active versions valid from ``start``."""
    return rows.select("*", *_open_columns(at(start), batch_ts))


def active_only(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(ACTIVE))


def version_history(dim: DataFrame, key: str, value) -> DataFrame:
    """All versions of one business key in order of validity."""
    return dim.filter(F.col(key) == F.lit(value)).orderBy(START)


def detect_changes(
    dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """The snapshot with a column ``mudanca``: novo, alterado or sem_alteracao.

    One left join against the active versions; the comparison is null-safe, so the
    three classes split the snapshot without gaps. Keys only in ``dim`` are left alone.
    """
    _require_tracked(tracked)
    active = active_only(dim).select(F.col(key).alias("_key"), F.struct(*tracked).alias("_old"))
    label = (
        F.when(F.col("_key").isNull(), NEW)
        .when(differs(tracked, "_old", "_new"), CHANGED)
        .otherwise(UNCHANGED)
    )
    return (
        snapshot.withColumn("_new", F.struct(*tracked))
        .join(active, F.col(key) == F.col("_key"), "left")
        .select(*snapshot.columns, label.alias(CHANGE))
    )


def change_counts(labelled: DataFrame) -> DataFrame:
    """One row: novos, alterados, sem_alteracao."""
    return labelled.agg(
        F.count_if(F.col(CHANGE) == NEW).alias("novos"),
        F.count_if(F.col(CHANGE) == CHANGED).alias("alterados"),
        F.count_if(F.col(CHANGE) == UNCHANGED).alias("sem_alteracao"),
    )


def new_keys(dim: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Snapshot rows whose key has no active version."""
    return snapshot.join(active_only(dim).select(key), key, "left_anti").select(*snapshot.columns)


def matched_pairs(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Key with the old and new values of each tracked column, where both sides have the key."""
    old = active_only(dim).select(key, *[F.col(c).alias(f"{c}_anterior") for c in tracked])
    return snapshot.select(key, *tracked).join(old, key, "inner")


def union_changes(labelled: DataFrame) -> DataFrame:
    """New rows followed by changed rows; duplicates stay."""
    rows = labelled.drop(CHANGE)
    new = rows.where(labelled[CHANGE] == NEW)
    return new.unionByName(rows.where(labelled[CHANGE] == CHANGED))


def close_versions(dim: DataFrame, keys: DataFrame, key: str, batch_ts: str) -> DataFrame:
    """End the active versions of the given keys at the batch time."""
    hit = keys.select(F.col(key).alias("_key")).distinct()
    closes = F.col("_key").isNotNull() & F.col(ACTIVE)
    return dim.join(hit, F.col(key) == F.col("_key"), "left").select(
        *[_closed(c, closes, batch_ts) for c in dim.columns]
    )


def insert_missing(
    dim: DataFrame, snapshot: DataFrame, key: str, batch_ts: str, start: str | None = None
) -> DataFrame:
    """Add an active version for each key that has none."""
    opened = open_versions(new_keys(dim, snapshot, key), start or batch_ts, batch_ts)
    return dim.unionByName(opened)


def insert_versions(dim: DataFrame | None, rows: DataFrame, batch_ts: str) -> DataFrame:
    """Add every row as an active version starting now, whatever is there already."""
    opened = open_versions(rows, batch_ts, batch_ts)
    return opened if dim is None else dim.unionByName(opened)


def scd2_step(
    active: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    batch_ts: str,
    late_keys_from: str | None = BEGINNING,
) -> DataFrame:
    """What becomes of the active versions: kept, closed, and newly opened rows.

    One full outer join on the key and no second pass over either side: each pair
    yields the old row (as it was or closed) and, where needed, its new version.
    ``late_keys_from`` is the start for keys first seen now; None means the batch time.
    """
    _require_tracked(tracked)
    columns = active.columns
    business = [c for c in columns if c not in CONTROL_COLUMNS]
    old = active.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = snapshot.select(F.col(key).alias("_new_key"), F.struct(*business).alias("_new"))

    is_new = F.col("_old_key").isNull()
    is_changed = (
        F.col("_old_key").isNotNull()
        & F.col("_new_key").isNotNull()
        & differs(tracked, "_old", "_new")
    )
    start = F.when(is_new, at(late_keys_from or batch_ts)).otherwise(at(batch_ts))
    opened = {
        **{c: F.col(f"_new.{c}") for c in business},
        **dict(zip(CONTROL_COLUMNS, _open_columns(start, batch_ts))),
    }
    types = {f.name: f.dataType for f in active.schema}
    before = F.struct(*[_closed(c, is_changed, batch_ts, "_old.") for c in columns])
    after = F.struct(*[opened[c].cast(types[c]).alias(c) for c in columns])
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    rows = F.array_compact(
        F.array(F.when(~is_new, before), F.when(is_new | is_changed, after))
    )
    return pairs.select(F.inline(rows))


def scd2_apply(
    dim: DataFrame | None,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    batch_ts: str,
    late_keys_from: str | None = BEGINNING,
) -> DataFrame:
    """The dimension after loading a snapshot; ``dim`` is None on the first load."""
    _require_tracked(tracked)
    if dim is None:
        return open_versions(snapshot, BEGINNING, batch_ts)
    history = dim.filter(~F.col(ACTIVE))
    step = scd2_step(active_only(dim), snapshot, key, tracked, batch_ts, late_keys_from)
    return history.unionByName(step)


def scd2_incremental(
    dim: DataFrame | None,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    batch_ts: str,
    late_keys_from: str | None = BEGINNING,
) -> DataFrame:
    """Like ``scd2_apply``, but only new and changed rows reach the versioning step."""
    if dim is None:
        return scd2_apply(None, snapshot, key, tracked, batch_ts)
    changes = union_changes(detect_changes(dim, snapshot, key, tracked))
    return scd2_apply(dim, changes, key, tracked, batch_ts, late_keys_from)


def _open_columns(start: Column, batch_ts: str) -> list[Column]:
    return [
        start.alias(START),
        F.lit(None).cast("timestamp").alias(END),
        F.lit(True).alias(ACTIVE),
        at(batch_ts).alias(STAMP),
    ]


def _closed(column: str, closes: Column, batch_ts: str, prefix: str = "") -> Column:
    value = F.col(prefix + column)
    if column == ACTIVE:
        value = F.when(closes, False).otherwise(value)
    elif column == END:
        value = F.when(closes, at(batch_ts)).otherwise(value)
    return value.alias(column)


def _require_tracked(tracked: Sequence[str]) -> None:
    if not tracked:
        raise ValueError("name at least one tracked column to detect changes")
