"""Loads of the layered lake, each safe to run again after a failure.

The batch time is a parameter: one run stamps one instant. Bronze, silver and the fact hand
on batches by name, so these times need not rise; dimension loads must be later than the last.
Loads collect only watermarks, labels of batches and parts, and counts to the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from lapidar.operators import scd2
from lapidar.operators.checks import IntegrityError, dimension_scd2, require_passed
from lapidar.operators.control import LAYER, get_checkpoint, save_checkpoint, save_taken, taken_batches
from lapidar.operators.facts import FACT_HASHES, incremental_filter, max_watermark
from lapidar.operators.ingest import AUDIT_COLUMNS, bronze_audit
from lapidar.operators.key_bitmaps import BITMAP_BYTES, key_bitmaps, with_key_in
from lapidar.operators.merge import changed_rows, upsert
from lapidar.operators.skew import hot_keys
from lapidar.plans.dimensions import DIMENSIONS
from lapidar.plans.sales import FACT, full_fact, odd_keys_of, short_fact
from lapidar.plans.silver import Seen, SilverReport, repeated_keys, silver_build
from lapidar.sources.lake import Lake
from lapidar.sources.landing import MALFORMED, assert_not_empty, read_landing_marked
from lapidar.sources.schemas import (
    GOLD_INPUTS,
    KEY_BUCKETS,
    KEY_RANGE,
    PROCESSING_ORDER,
    primary_key,
    raw_schema,
    table_schema,
)

FACT_SOURCES = ("pedidos", "itens_pedido", "pagamentos_pedido")
# Notes of silver loads for the fact: the orders that changed rows belong to or have left.
CHANGED = "pedidos_alterados"
# Orders of the fact with a key that their dimension does not have yet.
PENDING = "fato_vendas_pendentes"
ACTIVE_PART = "ativo"
# Rows that a load keeps for itself until it ends.
WORK = "trabalho"
# A larger load compares and writes its rows in slices of about so many, one after the other: the shuffle
# files of one slice are gone before the next begins.
SLICE_ROWS = 50_000_000
# So many bytes of the fact's files are shown at once where a view is written; its shuffles take up to ten times as much.
SHOWN_BYTES = 1 << 30


# -- bronze --------------------------------------------------------------------------


@dataclass(frozen=True)
class BronzeReport:
    linhas: int
    em_quarentena: int

    def __str__(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def quarantine_of(table: str) -> str:
    return f"quarentena_{table}"


def load_bronze(lake: Lake, landing: str, table: str, batch_ts: str) -> BronzeReport | None:
    """Append the landing files of a table with audit columns; returns the numbers of rows.

    The batch time names the batch. Running it again replaces the batch as long as silver
    has not taken it, and does nothing (None) once it has. Batches may come in any order:
    silver keeps a ledger of those it has taken. Rows with too many or too few fields go to
    the quarantine table with their file and text; only a batch that has some is read again.
    """
    label = "b" + "".join(c for c in batch_ts if c.isdigit())
    rows = bronze_audit(read_landing_marked(lake.spark, landing, table), table, batch_ts)
    job = f"bronze_{table}"
    if label in taken_batches(lake, f"silver_{table}"):
        if not lake.has_batch(LAYER, job, label):  # the run that wrote it died before its quarantine was whole
            _save_bronze_report(lake, job, label, BronzeReport(-1, append_quarantine(lake, rows, table, label)))
        return None
    report = append_bronze(lake, rows, table, label)
    _save_bronze_report(lake, job, label, report)
    return report


def append_bronze(lake: Lake, rows: DataFrame, table: str, label: str) -> BronzeReport:
    """Write audited rows as a bronze batch, and those that are malformed as a batch of the quarantine."""
    seen, bad = Observation(), F.col(MALFORMED).isNotNull()
    counted = rows.observe(seen, F.count_if(~bad).alias("linhas"), F.count_if(bad).alias("em_quarentena"))
    lake.append(counted.filter(~bad).drop(MALFORMED), "bronze", table, label)
    report = BronzeReport(**seen.get)
    if report.em_quarentena or lake.has_batch("bronze", quarantine_of(table), label):  # an earlier try's are replaced
        append_quarantine(lake, rows, table, label)
    return report


def append_quarantine(lake: Lake, rows: DataFrame, table: str, label: str) -> int:
    """The malformed rows: their text, the fields that Spark made of it, file and time."""
    seen = Observation()
    fields = F.array(*raw_schema(table).names).alias("campos")
    bad = rows.filter(F.col(MALFORMED).isNotNull()).select(MALFORMED, fields, *AUDIT_COLUMNS)
    lake.append(bad.observe(seen, F.count(F.lit(1)).alias("n")), "bronze", quarantine_of(table), label)
    return seen.get["n"]


def _save_bronze_report(lake: Lake, job: str, label: str, report: BronzeReport) -> None:
    rows = lake.spark.createDataFrame([(report.linhas, report.em_quarentena)], "linhas long, em_quarentena long")
    lake.append(rows.coalesce(1), LAYER, job, label)


# -- silver --------------------------------------------------------------------------


def load_silver(
    lake: Lake, table: str, batch_ts: str, key_types: Mapping[str, str] | None = None
) -> SilverReport:
    """Bring the bronze batches that silver has not taken yet into silver.

    The ledger holds batches, not a time, so a batch that is written late or stamped early
    is not passed by. Batches written while this load runs belong to the next one.
    """
    job = f"silver_{table}"
    taken = taken_batches(lake, job)
    new = [b for b in lake.batches("bronze", table) if b not in taken]
    if not new:
        assert_exists(lake, "bronze", table)
        return SilverReport()
    report = merge_silver(lake, lake.read_batch("bronze", table, *new), table, batch_ts, key_types)
    save_taken(lake, job, taken | set(new))
    return report


def assert_exists(lake: Lake, layer: str, table: str) -> None:
    if not lake.exists(layer, table):
        raise FileNotFoundError(f"no data for {layer}.{table} below {lake.root}")


def merge_silver(
    lake: Lake,
    bronze: DataFrame,
    table: str,
    batch_ts: str,
    key_types: Mapping[str, str] | None = None,
    noted_as: str | None = None,
) -> SilverReport:
    """Upsert bronze rows into silver; reports rows read, lost, discarded, and new or changed.

    Before a source of the fact is replaced, the orders that its new or changed rows belong
    to, or belonged to before, are noted in ``CHANGED`` under the version that is about to be
    written; ``noted_as`` ends the note's label.

    Rows equal to what silver holds are left alone. Of a table split by key only the
    touched parts are read and rewritten; one that is laid out in another way is read
    whole and split by this load. A row whose newest version breaks a rule
    keeps its earlier silver version, and rows deleted at the source stay.
    """
    if bronze.isEmpty():
        return SilverReport()
    seen, repeated = Seen(), repeated_keys(bronze, table, key_types)
    rows = silver_build(bronze, table, batch_ts, key_types, seen, repeated)
    part = key_part(table, key_types)
    held, work = [] if repeated is None else [repeated], None
    try:
        if not lake.exists("silver", table):
            # no fact can be older than the first load of one of its sources: nothing to note
            if part is None:
                lake.publish(rows, "silver", table)
            else:
                lake.publish_parts(rows, "silver", table, part, [], [primary_key(table)])
            return seen.report()

        key, columns = primary_key(table), table_schema(table).names
        slices = 1 if part is None or repeated is None else -(-bronze.count() // SLICE_ROWS)
        if slices > 1:  # too much to hold, and no shuffle is needed to have the rows again
            # one row whatever the rows are: Spark leaves out what it knows to be empty, and its counts with it
            touched = rows.agg(F.collect_set(part)).first()[0]
        else:
            held.append(rows := rows.persist())
            touched = None if part is None else _labels(rows, part)
        there = [] if part is None else lake.parts("silver", table)
        other_layout = any(not label.startswith(part_prefix(table, key_types)) for label in there)
        if other_layout:
            touched = {*touched, *there}
        known = None if part is None or other_layout else set(touched) & set(there)
        target = lake.read("silver", table, known) if known is None or known else rows.limit(0)
        compared = lambda old, new: changed_rows(old, new, key, columns, ("_ingestion_timestamp", "_source_file"))
        if slices > 1:
            # what the comparison shuffles goes with its slice; held in memory, it would stay as long as the rows
            work = f"{table}-{uuid.uuid4().hex}"
            for i, labels in enumerate(_dealt(touched, slices)):
                new = rows.filter(part.isin(labels) | part.isNull() if i == 0 else part.isin(labels))
                old = None if known is None else known & set(labels)
                if known is None or old:
                    new = compared(target if known is None else lake.read("silver", table, old), new)
                lake.append(new, WORK, work, f"{i:05d}")
            changed = lake.read(WORK, work)
        else:
            changed = (compared(target, rows) if known is None or known else rows).persist()
            held.append(changed)
        count = changed.count()
        report = seen.report(count)
        if count == 0:
            return report
        if table in FACT_SOURCES:
            label = f"{table}.{lake.next_version('silver', table):08d}" + (f".{noted_as}" if noted_as else "")
            lake.append(_orders_of(target, changed, key), "silver", CHANGED, label)
        merged = upsert(target, changed, key)
        if part is None:
            lake.publish(merged, "silver", table)
        else:
            lake.publish_parts(merged, "silver", table, part, touched, [key])
        return report
    finally:
        for df in held:
            df.unpersist()
        if work is not None:
            lake.remove_batches(WORK, work)


def _dealt(labels: Iterable[str | None], groups: int) -> list[list[str]]:
    """Neighbouring labels in up to so many groups; at least one."""
    labels = sorted(x for x in labels if x is not None)
    size = max(1, -(-len(labels) // groups))
    return [labels[i : i + size] for i in range(0, len(labels), size)] or [[]]


def _orders_of(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Orders, as text, of new or changed rows and those that these rows have left."""
    order = F.col("id_pedido").cast("string").alias("id_pedido")
    if key == "id_pedido":
        return new.select(order)
    now = new.select(key, F.col("id_pedido").alias("_now"))
    left = old.select(key, "id_pedido").join(now, key).filter("NOT id_pedido <=> _now")
    return new.select(order).unionByName(left.select(order)).filter("id_pedido IS NOT NULL").distinct()


def noted_orders(lake: Lake, key_type: DataType, labels: Iterable[str]) -> list[DataFrame]:
    """The orders of these notes, one frame or none."""
    labels = list(labels)
    return [lake.read_batch("silver", CHANGED, *labels).select(F.col("id_pedido").cast(key_type))] if labels else []


def open_notes(lake: Lake, taken: set[str]) -> list[str]:
    """Notes that are not taken and whose silver version is there for readers."""
    versions = {t: lake.version("silver", t) for t in FACT_SOURCES}
    labels = (b for b in lake.batches("silver", CHANGED) if b not in taken)
    return [b for b in labels if int(b.split(".")[1]) <= versions[b.split(".")[0]]]


def key_part(table: str, key_types: Mapping[str, str] | None = None) -> Column | None:
    """Label of the part a row of a large table belongs to; None for tables kept whole.

    Numbers are split by range, as new rows gather in the last ones. Text keys have no such
    ranges and are split by hash: a batch of few keys touches few buckets, one of very many
    all of them.
    """
    prefix, key = part_prefix(table, key_types), F.col(primary_key(table))
    if prefix is None:
        return None
    number = F.floor(key / F.lit(KEY_RANGE[table])) if prefix == "k" else F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))
    return F.concat(F.lit(prefix), number)


def part_prefix(table: str, key_types: Mapping[str, str] | None = None) -> str | None:
    """How the labels of a table's parts begin; it tells the layout."""
    if table not in KEY_RANGE:
        return None
    is_text = isinstance(table_schema(table, key_types)[primary_key(table)].dataType, StringType)
    return f"h{KEY_BUCKETS}_" if is_text else "k"


# -- gold dimensions -----------------------------------------------------------------


def load_dimension(
    lake: Lake, name: str, batch_ts: str, late_keys_from: str | None = scd2.BEGINNING
) -> dict[str, int]:
    """Apply the current silver state to a dimension; returns the change counts.

    Active and closed versions live in separate parts: a load rewrites the active part
    and adds one part with the versions it closed. Nothing changed, nothing written.
    """
    dim = DIMENSIONS[name]
    snapshot = dim.snapshot(*[assert_not_empty(lake.read("silver", t), t) for t in dim.inputs])
    # a label of its own for each load, so that no load replaces another's closed versions
    label = F.when(F.col(scd2.ACTIVE), ACTIVE_PART).otherwise(F.lit(f"h{lake.next_version('gold', name)}"))
    if not lake.exists("gold", name):
        first = scd2.scd2_apply(None, snapshot, dim.key, dim.tracked, batch_ts)
        lake.publish_parts(first, "gold", name, label, [ACTIVE_PART])
        return {"novos": lake.read("gold", name).count(), "alterados": 0, "sem_alteracao": 0}

    active = lake.read("gold", name, [ACTIVE_PART])
    labelled = scd2.detect_changes(active, snapshot, dim.key, dim.tracked)
    counts = scd2.change_counts(labelled).first().asDict()
    if counts["novos"] or counts["alterados"]:
        last = _first_value(max_watermark(active, "_gold_processed_at"))
        if last is not None and _instant(batch_ts) <= _instant(last):
            raise ValueError(f"{name}: batch time {batch_ts} is not later than that of the last load, {last}")
        step = scd2.scd2_step(active, snapshot, dim.key, dim.tracked, batch_ts, late_keys_from)
        lake.publish_parts(step, "gold", name, label, [ACTIVE_PART])
    return counts


def persist_and_validate(lake: Lake, name: str, compact: bool = True) -> bool:
    """Compact a dimension and check its SCD2 invariants; False when a check fails."""
    try:
        there = lake.exists("gold", name)
        if there and compact:
            lake.compact("gold", name)
        dim = lake.read("gold", name) if there else None
        require_passed(dimension_scd2(dim, name, DIMENSIONS[name].key))
        return True
    except IntegrityError:
        return False


# -- gold fact -----------------------------------------------------------------------


def load_fact(lake: Lake, batch_ts: str, late_keys: bool = True) -> int:
    """Rebuild the orders that changed in any of the three sources since the last run.

    Which ones: the orders in notes of silver loads that this job has not taken, rows above
    each source's own watermark (tables that others have written), and, with ``late_keys``,
    orders that lack a key which a dimension has by now. A silver load stamped like an
    earlier one, an item after its order and a client after their order all reach the
    fact. Returns the number of orders rebuilt.
    """
    notes = open_notes(lake, taken := taken_batches(lake, FACT))
    marks = get_checkpoint(lake, FACT, FACT_SOURCES)
    fresh = {
        t: incremental_filter(lake.read("silver", t), "_silver_processed_at", marks[t])
        for t in FACT_SOURCES
    }
    tops = reduce(
        DataFrame.unionByName,
        [
            max_watermark(df, "_silver_processed_at").select(
                F.lit(t).alias("fonte"), F.col("max_ts").cast("string").alias("marca")
            )
            for t, df in fresh.items()
        ],
    )
    new_marks = {r["fonte"]: r["marca"] for r in tops.collect() if r["marca"]}
    key_type = fresh[FACT_SOURCES[0]].schema["id_pedido"].dataType
    found = orders_with_late_keys(lake, key_type) if late_keys else None
    late = [found] if found is not None and not found.isEmpty() else []
    if not new_marks and not notes and not late:
        return 0
    changed = [df.select(F.col("id_pedido").cast(key_type)) for t, df in fresh.items() if t in new_marks]
    count = merge_fact(lake, reduce(DataFrame.unionByName, changed + noted_orders(lake, key_type, notes) + late), batch_ts)
    save_checkpoint(lake, FACT, {**marks, **new_marks})
    if notes:
        save_taken(lake, FACT, taken | set(notes))
    return count


def merge_fact(lake: Lake, order_ids: DataFrame, batch_ts: str) -> int:
    """Replace the fact rows of the given orders by rows built from silver.

    The fact is split by order month. Only months that hold or will hold one of these
    orders are rewritten. Running it twice gives the same rows.
    """
    sources = {t: lake.read("silver", t) for t in FACT_SOURCES}
    dims = {name: lake.read("gold", name) for name in DIMENSIONS}
    if not lake.exists("gold", FACT):
        publish_fact(lake, *sources.values(), dims, batch_ts, lambda missing: lake.publish(missing, "gold", PENDING))
        return sources["pedidos"].count()

    held = [order_ids.filter("id_pedido is not null").distinct().persist()]
    affected = held[0]
    try:
        count = affected.count()
        if count == 0:
            return 0
        near = near_keys(affected, "id_pedido")
        bitmaps = _bitmaps_if_smaller(affected, count)
        if bitmaps is not None:
            held.append(bitmaps)

        def among(df: DataFrame, wanted: bool = True) -> DataFrame:
            if bitmaps is not None:
                return with_key_in(df, "id_pedido", bitmaps, wanted)
            return df.join(affected, "id_pedido", "left_semi" if wanted else "left_anti").select(*df.columns)

        orders, items, payments = [among(df.filter(near)) for df in sources.values()]
        if bitmaps is None:
            orders, items = orders.persist(), items.persist()
            held += [orders, items]
        # else no shuffle is needed to have them again, and held they would fill disks
        holding = among(lake.read("gold", FACT).filter(near).select("id_pedido", "data_pedido"))
        months = _labels(
            holding.select("data_pedido").unionByName(orders.select("data_pedido")),
            month_label("data_pedido"),
        )
        known, kept = set(months) & set(lake.parts("gold", FACT)), None
        if known:
            old = lake.read("gold", FACT, known)
            kept = among(old, wanted=False)
            # rows that no join shuffles stay by month; many small files are gathered again
            in_place = bitmaps is not None or count <= FEW_ORDERS
            if not in_place or len(old.inputFiles()) > FILES_PER_PART * len(known):
                kept = lake.gathered(kept, month_label("data_pedido"), FACT_HASHES)
        publish_fact(
            lake, orders, items, payments, dims, batch_ts, lambda missing: _replace_pending(lake, affected, missing), months, kept
        )
        return count
    finally:
        for df in held:
            df.unpersist()


def publish_fact(
    lake: Lake,
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    dims: Mapping[str, DataFrame],
    batch_ts: str,
    before: Callable[[DataFrame], None] | None = None,
    replaced: Iterable[str] = (),
    kept: DataFrame | None = None,
) -> None:
    """Write the fact rows of these orders, and ``kept`` rows, by order month; ``before`` gets the ``missing_keys``."""
    odd = odd_keys_of(orders, items, payments, dims)
    try:
        if before is not None:
            before(missing_keys(orders, items, payments, odd))
        hot, version = hot_keys(items, "id_pedido"), lake.next_version("gold", FACT)
        one_type = len({df.schema["id_pedido"].dataType for df in (orders, items, payments)}) == 1
        slices = max(1, -(-items.select("id_pedido").count() // SLICE_ROWS)) if one_type else 1
        for i in range(slices):
            own = [df if slices == 1 else _slice(df, i, slices) for df in (orders, items, payments)]
            short, last = short_fact(*own, odd, hot), i == slices - 1
            lake.publish_parts(
                short, "gold", FACT, month_label("data_pedido"), replaced, finish=lambda df: full_fact(df, batch_ts),
                unmoved=kept if last else None, more=version, last=last,
            )
    finally:
        for df in odd.values():
            if df is not None:
                df.unpersist()


def _slice(rows: DataFrame, i: int, slices: int) -> DataFrame:
    """One of so many slices of whole orders."""
    return rows.filter(F.pmod(F.xxhash64("id_pedido"), F.lit(slices)) == i)


def shown(lake: Lake, view: Callable[[DataFrame], DataFrame], to: Lake, name: str) -> DataFrame:
    """The view of the lake's fact. That of a large fact is written, months after months, below ``to``.

    Joins with large dimensions move the fact once each; that way, only some months' shuffle files
    are there at a time. ``view`` has to make each row of one fact row.
    """
    groups: list[list[str]] = [[]]
    room = SHOWN_BYTES
    for part, size in sorted(lake.part_bytes("gold", FACT).items()):
        if groups[-1] and size > room:
            groups.append([])
            room = SHOWN_BYTES
        groups[-1].append(part)
        room -= size
    if len(groups) == 1:
        return view(lake.read("gold", FACT))
    for i, months in enumerate(groups):
        to.append(view(lake.read("gold", FACT, months)), "gold", name, f"{i:05d}")
    return to.read("gold", name)


# Up to so many orders, Spark broadcasts them as they are.
FEW_ORDERS = 100_000
# A month of the fact that has more files on average is gathered into few by the next load that touches it.
FILES_PER_PART = 8


def _bitmaps_if_smaller(keys: DataFrame, count: int) -> DataFrame | None:
    """The keys as bitmaps, held, where these take less room than the keys; None for few keys or text."""
    column = F.col(keys.columns[0])
    if count <= FEW_ORDERS or isinstance(keys.schema[0].dataType, StringType):
        return None
    buckets = keys.select(F.countDistinct(F.bitmap_bucket_number(column.cast("long")))).first()[0]
    if buckets * BITMAP_BYTES > count * 8:
        return None
    bitmaps = key_bitmaps(keys, keys.columns[0]).persist()
    bitmaps.count()
    return bitmaps


# -- keys that come after the orders that have them --------------------------------------


def missing_keys(
    orders: DataFrame, items: DataFrame, payments: DataFrame, odd: Mapping[str, DataFrame | None]
) -> DataFrame:
    """id_pedido, dimensao, chave: keys of these orders that no version of their dimension has."""
    holder = {"id_produto": items, "id_metodo": payments}
    found = [lost_keys(orders.limit(0), "id_pedido", "")]
    for name, keys in odd.items():
        if keys is not None:
            key = DIMENSIONS[name].key
            unknown = keys.filter(F.col("_versions").isNull()).select(key)
            found.append(lost_keys(holder.get(key, orders).select("id_pedido", key).join(unknown, key, "left_semi"), key, name))
    return reduce(DataFrame.unionByName, found).distinct()


def lost_keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.select("id_pedido", F.lit(name).alias("dimensao"), F.col(key).cast("string").alias("chave"))


def _replace_pending(lake: Lake, affected: DataFrame, missing: DataFrame) -> None:
    """The index of orders that wait for a key, with these orders' entries replaced.

    It is written before the fact: an entry too many costs one rebuild, one too few would lose a key.
    """
    missing = missing.persist()
    try:
        if lake.exists("gold", PENDING):
            old = lake.read("gold", PENDING)
            if missing.isEmpty() and old.join(affected, "id_pedido", "left_semi").isEmpty():
                return
            missing = old.join(affected, "id_pedido", "left_anti").select(*missing.columns).unionByName(missing)
        lake.publish(missing.hint("rebalance"), "gold", PENDING)
    finally:
        missing.unpersist()


def orders_with_late_keys(lake: Lake, key_type: DataType) -> DataFrame | None:
    """Orders of the index whose dimension has their key by now; only keys are read of the dimensions."""
    if not lake.exists("gold", PENDING):
        return None
    pending = lake.read("gold", PENDING)
    waiting = [r["dimensao"] for r in pending.select("dimensao").distinct().collect()]
    found = []
    for name in waiting:
        keys = lake.read("gold", name).select(F.col(DIMENSIONS[name].key).cast("string").alias("chave"))
        found.append(pending.filter(F.col("dimensao") == name).join(keys, "chave", "left_semi"))
    return reduce(DataFrame.unionByName, found).select(F.col("id_pedido").cast(key_type)) if found else None


# Width and number of the key ranges that a load passes to its scans as a filter.
NEAR_WIDTH = 1_000_000
NEAR_RANGES = 200


def near_keys(keys: DataFrame, key: str) -> Column:
    """A filter that holds for all the keys and lets scans skip most other rows.

    It names the ranges that contain a key, so Parquet leaves out row groups whose
    statistics lie outside. Neighbouring ranges are one; where there are many, those with
    the smallest gaps between them are joined. Text keys have no ranges: their filter is
    "true", and the joins alone select the rows.
    """
    if isinstance(keys.schema[key].dataType, StringType):
        return F.lit(True)
    starts = (
        keys.select((F.floor(F.col(key) / NEAR_WIDTH) * NEAR_WIDTH).alias("start"))
        .distinct()
        .collect()
    )
    starts = sorted(r["start"] for r in starts if r["start"] is not None)
    if not starts:
        return F.lit(False)
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(starts, starts[1:])) if b - a > NEAR_WIDTH), reverse=True)
    cuts = sorted(i + 1 for _, i in gaps[: NEAR_RANGES - 1])
    ranges = [
        (F.col(key) >= starts[a]) & (F.col(key) < starts[b - 1] + NEAR_WIDTH)
        for a, b in zip([0, *cuts], [*cuts, len(starts)])
    ]
    return reduce(Column.__or__, ranges)


def month_label(column: str) -> Column:
    return F.coalesce(F.date_format(column, "'m'yyyyMM"), F.lit("sem_data"))


# -- runs over many tables -----------------------------------------------------------


def run_tables(
    spark: SparkSession,
    step: str,
    tables: Sequence[str],
    action: Callable[[str], object],
    workers: int = 4,
) -> DataFrame:
    """Run an action per table; a failure is reported and the other tables go on.

    Rows (etapa, tabela, situacao, detalhe). Independent tables are submitted together
    so that small ones do not leave the cluster idle.
    """

    def attempt(table: str) -> tuple[str, str, str, str]:
        try:
            return step, table, "ok", str(action(table))
        except Exception as error:  # noqa: BLE001 - reported, see docstring
            return step, table, "falha", f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(workers) as pool:
        rows = list(pool.map(attempt, tables))
    return spark.createDataFrame(rows, "etapa string, tabela string, situacao string, detalhe string")


def run_layer(
    lake: Lake,
    stage: str,
    batch_ts: str,
    landing: str | None = None,
    key_types: Mapping[str, str] | None = None,
    tables: Iterable[str] = PROCESSING_ORDER,
) -> DataFrame:
    """Load all tables of the bronze or silver layer."""
    if stage == "bronze":
        return run_tables(
            lake.spark, stage, list(tables), lambda t: load_bronze(lake, landing, t, batch_ts)
        )
    if stage == "silver":
        return run_tables(
            lake.spark, stage, list(tables), lambda t: load_silver(lake, t, batch_ts, key_types)
        )
    raise ValueError(f"unknown stage {stage!r}; use bronze or silver")


def run_dimensions(lake: Lake, batch_ts: str) -> DataFrame:
    return run_tables(
        lake.spark, "dimensoes", list(DIMENSIONS), lambda n: load_dimension(lake, n, batch_ts)
    )


def run_all(
    lake: Lake, landing: str, batch_ts: str, key_types: Mapping[str, str] | None = None
) -> DataFrame:
    """Landing to fact: all silver tables before the dimensions, these before the fact.

    A failed step keeps the steps that need it from running.
    """
    report = run_layer(lake, "bronze", batch_ts, landing, key_types)
    if not failures(report):
        report = report.unionByName(run_layer(lake, "silver", batch_ts, None, key_types))
    if not failures(report):
        report = report.unionByName(run_dimensions(lake, batch_ts))
    if not failures(report):
        report = report.unionByName(
            run_tables(lake.spark, "fato", [FACT], lambda _: load_fact(lake, batch_ts))
        )
    return report


def failures(report: DataFrame) -> list[str]:
    """Names of the failed tables; a caller exits non-zero when there are any."""
    return [r["tabela"] for r in report.filter("situacao = 'falha'").collect()]


def silver_ready(lake: Lake, tables: Iterable[str] = GOLD_INPUTS) -> DataFrame:
    """Which silver tables can be read and hold rows."""
    return run_tables(
        lake.spark,
        "silver_ready",
        list(tables),
        lambda t: assert_not_empty(lake.read("silver", t), t) and "com linhas",
    )


def _labels(rows: DataFrame, label: Column) -> list[str]:
    return [r[0] for r in rows.select(label.alias("label")).distinct().collect()]


def _instant(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _first_value(one_row: DataFrame) -> str | None:
    return one_row.select(F.col(one_row.columns[0]).cast("string")).first()[0]
