"""Exact top-k by integer inner product over a bit-sliced index.

Vectors are cut into blocks as they are read, with no shuffle. In a block each attribute (component)
is kept as bit slices: one bitmap over the block's rows for each bit of value minus minimum. A query
adds the slices of all attributes, shifted by the set bits of its own components, with carry-save
adders on bitmaps; a negative component adds the complements instead. The sum is again a set of
slices, and the best rows are picked from the most significant slice downward. Rows that tie at the
boundary are told apart by vec_id, in whose order a block is sorted. Every query meets every block;
a second step ranks the few rows each block returns.

Components and scores are whole numbers of any size: rows with a component of 2^27 or more go to
blocks of their own, which compute beyond 64 bits. ``score`` is null where it passes a long, ``exact``
has every score as text.

Defined results: vectors that are null or hold a null or a non-finite component take no part, nor do
those with a component whose 256-fold passes a double, nor rows without vec_id; shorter vectors are
padded with zeros; repeated vec_ids count as rows of their own among the candidates,
as one query (their smallest vector) among the queries, and never answer themselves; ties go to the
smaller vec_id; fewer than k candidates give as many rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapidar.llm.common import written

SCALE = 256
TOP = 5
QUERIES_EVERY = 50
BLOCK_ROWS = 32_768
NARROW, WIDE_ROWS = float(1 << 27), 256  # components of ordinary blocks; rows of the others
QUERY_ROWS = 256
BLOCK = "lane long, ids binary, lows binary, bits binary, slices binary"
HITS = "query_id long, vec_id long, score long, exact string, key string"


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector: whole numbers (as doubles, which hold them exactly) of equal dimension; rows that take no part are gone."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    fits = F.forall(scaled, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # not true of NaN, the greatest of all
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fits)
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    # a double of 2^52 or more has no fraction
    vector = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    padded = F.concat(vector, F.array_repeat(F.lit(0.0), F.lit(size) - F.size("embedding")))
    return rows.select("vec_id", padded.alias("vector"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _whole(values: np.ndarray) -> np.ndarray:
    """Doubles without a fraction as whole numbers: 64-bit, or Python's where these don't suffice."""
    if np.abs(values).max(initial=0) < float(1 << 62):
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], dtype=object).reshape(values.shape)


def _block(lane: int, ids: np.ndarray, values: np.ndarray) -> dict:
    order = np.argsort(ids, kind="stable")
    ids, lows, values = ids[order], values.min(axis=0), _whole(values[order])
    words = -(-len(ids) // 64)
    least = _whole(lows).astype(values.dtype)
    bits = np.array([int(x).bit_length() for x in values.max(axis=0) - least], dtype=np.int64)
    slices = np.zeros((int(bits.sum()), words * 8), dtype=np.uint8)
    at = 0
    for i, n in enumerate(bits):
        above = values[:, i] - least[i]
        shifts = np.arange(n) if values.dtype != object else np.array(range(n), dtype=object)
        packed = np.packbits(((above[None, :] >> shifts[:, None]) & 1).astype(np.uint8), axis=1, bitorder="little")
        slices[at : at + n, : packed.shape[1]] = packed
        at += n
    parts = {"ids": ids, "lows": lows, "bits": bits, "slices": slices}
    return {"lane": lane, **{k: v.tobytes() for k, v in parts.items()}}


def build_blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``rows`` vectors of a partition, in the order they are read; large components apart, by their size."""
    schema = pa.schema([("lane", pa.int64()), *((k, pa.binary()) for k in ("ids", "lows", "bits", "slices"))])
    lane, held = TaskContext.get().partitionId() << 32, {}

    def out(size: int) -> pa.RecordBatch:
        nonlocal lane
        ids, values = zip(*held.pop(size), strict=True)
        lane += 1
        return pa.RecordBatch.from_pylist([_block(lane, np.concatenate(ids), np.concatenate(values))], schema=schema)

    for batch in batches:
        every_id, every = batch.column("vec_id").to_numpy(), _matrix(batch)
        most = np.abs(every).max(axis=1, initial=0.0)
        sizes = np.where(most < NARROW, 0, np.frexp(most)[1] // 64 + 1)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            limit = min(rows, WIDE_ROWS) if size else rows
            while len(at):
                here = held.setdefault(int(size), [])
                part, at = np.split(at, [limit - sum(len(i) for i, _ in here)])
                here.append((every_id[part], every[part]))
                if sum(len(i) for i, _ in here) >= limit:
                    yield out(int(size))
    for size in list(held):
        yield out(size)


def sort_key(n: int) -> str:
    """Text that sorts like the whole numbers, of up to 9999 hexadecimal digits."""
    digits = f"{abs(n):x}"
    if n >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}" + digits.translate(_COMPLEMENT)


_COMPLEMENT = str.maketrans("0123456789abcdef", "fedcba9876543210")


class Block:
    """Bitmaps of a block; ``best`` adds and selects."""

    def __init__(self, row: dict) -> None:
        self.ids, self.bits = (np.frombuffer(row[k], dtype=np.int64) for k in ("ids", "bits"))
        self.lows = [int(x) for x in np.frombuffer(row["lows"])]
        words = -(-len(self.ids) // 64)
        slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(-1, words)
        self.every = np.full(words, np.uint64(2**64 - 1))
        if len(self.ids) % 64:
            self.every[-1] = np.uint64((1 << (len(self.ids) % 64)) - 1)
        self.slices = np.concatenate([slices, slices ^ self.every])
        self.attribute = np.repeat(np.arange(len(self.bits)), self.bits)
        self.bit = np.concatenate([np.arange(n) for n in self.bits]) if len(self.bits) else np.zeros(0, np.int64)

    def sum_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the weighted sum, least significant first, and the constant to add to it."""
        size, negative = np.abs(query), (query < 0).astype(bool)
        constant = sum(
            -int(n) * (low + (1 << int(b)) - 1) if minus else int(n) * low
            for n, minus, low, b in zip(size, negative, self.lows, self.bits, strict=True)
        )
        source, weight = [], []
        of, sign = size[self.attribute], negative[self.attribute]
        for shift in range(int(max(size, default=0)).bit_length()):
            chosen = np.flatnonzero(((of >> shift) & 1).astype(bool))
            source.append(chosen + np.where(sign[chosen], len(of), 0))
            weight.append(self.bit[chosen] + shift)
        if not source:
            return [], constant
        source, weight = np.concatenate(source), np.concatenate(weight)
        sums, carried, w = [], [], 0
        top = int(weight.max(initial=-1))
        while w <= top or carried:
            rows = np.concatenate([self.slices[source[weight == w]], *carried]) if w <= top else np.concatenate(carried)
            carried = []
            while len(rows) > 1:
                n = len(rows) // 3
                if n:
                    a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
                    half = a ^ b
                    carried.append((a & b) | (half & c))
                    rows = np.concatenate([half ^ c, rows[3 * n :]])
                else:
                    a, b = rows[:1], rows[1:]
                    carried.append(a & b)
                    rows = a ^ b
            sums.append(rows[0] if len(rows) else np.zeros_like(self.every))
            w += 1
        return sums, constant

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query_id, vec_id, score) of the k highest scores, ties to smaller vec_id."""
        sums, constant = self.sum_slices(query)
        open_, sure, n_sure = self.every.copy(), np.zeros_like(self.every), 0
        start, end = np.searchsorted(self.ids, [query_id, query_id + 1])
        for i in range(start, end):  # the query's own rows
            open_[i // 64] &= ~np.uint64(1 << (i % 64))
        for slice_ in reversed(sums):
            with_bit = open_ & slice_
            n = int(np.bitwise_count(with_bit).sum())
            if n_sure + n > k:
                open_ = with_bit
            else:
                sure, n_sure, open_ = sure | with_bit, n_sure + n, open_ & ~slice_
            if n_sure == k:
                break
        rows = [*_positions(sure, k), *_positions(open_, k - n_sure)]
        score = [sum(int(s[r // 64] >> np.uint64(r % 64)) % 2 << j for j, s in enumerate(sums)) + constant for r in rows]
        return [(query_id, int(self.ids[r]), s) for r, s in zip(rows, score, strict=True)]


def _positions(bitmap: np.ndarray, n: int) -> list[int]:
    """The first n set bits."""
    found: list[int] = []
    for w in np.flatnonzero(bitmap):
        if len(found) >= n:
            break
        word = int(bitmap[w])
        found += [int(w) * 64 + i for i in range(64) if word >> i & 1]
    return found[:n]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries in packs: their ids, and their vectors in four bytes a component where all of them fit."""
    for batch in batches:
        for start in range(0, batch.num_rows, QUERY_ROWS):
            part = batch.slice(start, QUERY_ROWS)
            values = _matrix(part)
            narrow = values.astype("<i4") if np.abs(values).max(initial=0) < float(1 << 31) else values
            columns = [part.column("vec_id").to_numpy().tobytes(), narrow.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["ids", "lows"])


def _queries(row: dict) -> Iterator[tuple[int, np.ndarray]]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    width = 1 if not row["lows"] else len(row["lows"]) // len(ids)
    for i, query_id in enumerate(ids):
        yield int(query_id), row["lows"][i * width : (i + 1) * width]


def _answer(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A block's row comes first, then all packs of queries."""
    names, block = [c.split()[0] for c in HITS.split(", ")], None
    schema = pa.schema(list(zip(names, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)))
    for batch in batches:
        hits: list[dict] = []
        for row in batch.to_pylist():
            if row["slices"] is not None:
                block = Block(row)
                continue
            for query_id, raw in _queries(row):
                four = len(raw) == 4 * len(block.bits)
                query = np.frombuffer(raw, "<i4").astype(np.int64) if four else _whole(np.frombuffer(raw))
                for hit in block.best(query_id, query, k):
                    fits = -(1 << 63) <= hit[2] < 1 << 63
                    values = (*hit[:2], hit[2] if fits else None, str(hit[2]), sort_key(hit[2]))
                    hits.append(dict(zip(names, values, strict=True)))
        yield pa.RecordBatch.from_pylist(hits, schema=schema)


def top_k(embeddings: DataFrame, is_query: Column, k: int = TOP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score, exact for every row where ``is_query`` holds, against all other rows."""
    rows = quantised(embeddings)
    index = written(rows.mapInArrow(lambda it: build_blocks(it, block_rows), BLOCK), "bit-slices")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    packs = written(asked.mapInArrow(_packed, "ids binary, lows binary"), "vec-queries")
    lanes = index.count()
    blocks = _numbered(index).select("place", "ids", "lows", "bits", "slices")
    each = F.explode(F.sequence(F.lit(0), F.lit(max(lanes, 1) - 1))).alias("place")
    queries = packs.select(each, "ids", "lows", *(F.lit(None).cast("binary").alias(c) for c in ("bits", "slices")))
    met = (
        blocks.unionByName(queries)
        .repartitionByRange(max(lanes, 1), "place")
        .sortWithinPartitions("place", F.col("slices").isNull())
        .mapInArrow(lambda it: _answer(it, k), HITS)
    )
    best = Window.partitionBy("query_id").orderBy(F.col("key").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "exact")


def _numbered(index: DataFrame) -> DataFrame:
    """The blocks with ``place`` from 0 without gaps; only their keys go through the one window."""
    keys = index.select("lane").withColumn("place", F.row_number().over(Window.orderBy("lane")) - 1)
    return index.join(keys, "lane")
