"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only lengths matter, and there are at most ``capacity`` different ones, so the plan is made on their
counts: items above a third of the capacity go at most two to a bin, the largest first with the
largest partner that fits; smaller items then fill, largest first, the smallest gap that holds them.
A step moves a whole run of equal items into a run of equal bins, and the plan is a short list of
such steps whatever the number of documents. Each piece has a rank among those of its length,
counted inside buckets; rank and length tell its bin and offset. No task and no driver sees the
documents as a whole.

Defined results: a null text counts as empty (one token, the separator); repeated rows are packed
each by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import array
import bisect
import functools
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapidar.llm.common import text_of, written

CAPACITY = 4096
SEPARATOR = 1
VOCABULARY = "word_bpe_49k.json"
PIECES_PER_BUCKET = 100_000
CACHED_WORDS = 1_000_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
# How the vocabulary cuts words, its own pattern and that for lower-case words of PLAIN characters.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PLAIN_CUTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Token ids of texts, put together from those of their words.

    White space ends every token of this vocabulary, so the words of a text can be encoded one by
    one; each different word is encoded once while it is in the cache. A word of ASCII and Latin
    letters is put together in turn from the runs of letters, digits and marks that no token of the
    vocabulary leaves, which many words share; any other word is encoded as a whole.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        self.tokenizer, self.cached, self.known, self.parts = _tokenizer(path), cached, {}, {}
        own = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in own["added_tokens"]]
        suffix = own["model"].get("end_of_word_suffix") if _cuts_words(own["normalizer"], own["pre_tokenizer"]) else None
        self.last = None  # of each id, whether it ends a run
        if suffix:
            tokens = self.tokenizer.get_vocab()
            self.last = np.zeros(max(tokens.values()) + 1, dtype=bool)
            self.last[[i for t, i in tokens.items() if t.endswith(suffix)]] = True

    def ids(self, texts: list[bytes], at_once: int = 256) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for i in range(0, len(texts), at_once):
            if len(self.known) > self.cached:
                self.known = {}
            if len(self.parts) > self.cached // 2:
                self.parts = {}
            known, split = self.known, [t.split() for t in texts[i : i + at_once]]
            self._learn(list(set().union(*split).difference(known)))
            for words in split:
                yield b"".join(map(known.__getitem__, words))

    def _learn(self, new: list[bytes]) -> None:
        text = b"\n".join(new).decode("utf-8", "replace")  # no word has a line end
        special, whole, cut = [s for s in self.special if s in text], [], []
        for word, own in zip(new, text.split("\n")):
            if self.last is None or not PLAIN.fullmatch(own) or special and any(s in own for s in special):
                whole.append((word, own))
            else:
                cut.append((word, PLAIN_CUTS.findall(own.lower())))
        found = self.tokenizer.encode_batch_fast([own for _, own in whole], add_special_tokens=False)
        self.known.update((word, array.array("I", x.ids).tobytes()) for (word, _), x in zip(whole, found, strict=True))
        parts = self.parts
        self._encode_parts(list(set().union(*(runs for _, runs in cut)).difference(parts)))
        self.known.update((word, parts[runs[0]] if len(runs) == 1 else b"".join([parts[x] for x in runs])) for word, runs in cut)

    def _encode_parts(self, new: list[str], at_once: int = 500) -> None:
        """Many runs as one text: a call costs more than the tokens of a run."""
        for i in range(0, len(new), at_once):
            runs = new[i : i + at_once]
            (found,) = self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            ends, data = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist(), ids.tobytes()
            self.parts.update((run, data[a:b]) for run, a, b in zip(runs, [0, *ends], ends, strict=False))
            if len(ends) != len(runs):
                raise ValueError("a run of letters, digits or marks is not one word of the vocabulary")


def _cuts_words(normalizer: dict | None, pre_tokenizer: dict | None) -> bool:
    """Whether a tokenizer lower-cases its text and cuts it by CUTS, and does nothing else to PLAIN words."""
    kinds = [x["type"] for x in (normalizer or {}).get("normalizers", ())]
    steps = (pre_tokenizer or {}).get("pretokenizers", ())
    if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return False
    split, level = steps
    spaces = normalizer["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
    cuts = split["pattern"] == {"Regex": CUTS} and split["behavior"] == "Removed" and split["invert"]
    return spaces and cuts and not level["add_prefix_space"] and not level["use_regex"]


@functools.cache
def _encoder(path: str) -> Encoder:
    """One for each worker process: the cache outlives a task."""
    return Encoder(path)


def tokenise(batches: Iterator[pa.RecordBatch], path: str, capacity: int = CAPACITY) -> Iterator[pa.RecordBatch]:
    """doc_id and text in UTF-8 to pieces of at most ``capacity`` tokens."""
    encoder, end = _encoder(path), np.array([SEPARATOR], dtype="<u4").tobytes()
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    schema = pa.schema(list(zip((c.split()[0] for c in PIECE.split(", ")), kinds, strict=True)))
    for batch in batches:
        rows: list[tuple[int, int, int, int, int]] = []
        texts = batch.column("text")
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(texts.to_pylist()), strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] or [pa.array([], k) for k in kinds], schema=schema)


@dataclass(frozen=True)
class Step:
    """Items of one length, from a rank on, into bins from a number on: ``each`` to a bin."""

    length: int
    rank: int
    each: int
    sequence: int
    offset: int


class _Bins:
    """Runs of bins by the gap they still have."""

    def __init__(self) -> None:
        self.next, self.gaps, self.runs = 0, [], {}

    def open(self, n: int) -> int:
        self.next += n
        return self.next - n

    def leave(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in self.runs:
                bisect.insort(self.gaps, gap)
            self.runs.setdefault(gap, []).append((sequence, n))

    def smallest(self, length: int) -> tuple[int, int, int] | None:
        """gap, first bin and number of a run with the smallest gap that holds ``length``; taken out."""
        at = bisect.bisect_left(self.gaps, length)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        run = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.gaps[at]
        return gap, *run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Steps that place ``counts[length]`` items of each length."""
    left, used = dict(counts), dict.fromkeys(counts, 0)
    steps, bins = [], _Bins()

    def place(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        steps.append(Step(length, used[length], each, sequence, offset))
        used[length] += n
        left[length] -= n

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        a = large[-1]
        n = left[a]
        at = bisect.bisect_right(large, min(a, capacity - a)) - 1
        if at >= 0 and large[at] == a and n < 2:
            at -= 1
        if at < 0:
            sequence = bins.open(n)
            place(a, n, 1, sequence, 0)
            bins.leave(capacity - a, sequence, n)
        elif large[at] == a:
            sequence = bins.open(n // 2)
            place(a, n // 2 * 2, 2, sequence, 0)
            bins.leave(capacity - 2 * a, sequence, n // 2)
        else:
            b = large[at]
            n = min(n, left[b])
            sequence = bins.open(n)
            place(a, n, 1, sequence, 0)
            place(b, n, 1, sequence, a)
            bins.leave(capacity - a - b, sequence, n)
            if not left[b]:
                large.pop(at)
        if not left[a]:
            large.pop()
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while n := left[length]:
            found = bins.smallest(length)
            gap, sequence, many = found or (capacity, bins.open(-(-n // (capacity // length))), -(-n // (capacity // length)))
            offset, each = capacity - gap, gap // length
            full = min(many, n // each)
            if full:
                place(length, full * each, each, sequence, offset)
                bins.leave(gap - each * length, sequence, full)
            if full < many and 0 < (rest := left[length]) < each:
                place(length, rest, rest, sequence + full, offset)
                bins.leave(gap - rest * length, sequence + full, 1)
                full += 1
            bins.leave(gap, sequence + full, many - full)
    return steps


def assign(batches: Iterator[pa.RecordBatch], steps: list[Step]) -> Iterator[pa.RecordBatch]:
    """Adds sequence_id and offset to pieces with rank (from 0) among those of their length."""
    steps = sorted(steps, key=lambda s: (s.length, s.rank))
    length, rank, each, sequence, offset = (
        np.array([getattr(s, k) for s in steps], dtype=np.int64) for k in ("length", "rank", "each", "sequence", "offset")
    )
    keys = (length << 44) + rank
    for batch in batches:
        size, place = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        step = np.searchsorted(keys, (size << 44) + place, side="right") - 1
        ahead = place - rank[step]
        found = (sequence[step] + ahead // each[step], offset[step] + ahead % each[step] * size)
        kept = [batch.column(c.split()[0]) for c in PIECE.split(", ")]
        names = [*(c.split()[0] for c in PIECE.split(", ")), "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found)], names=names)


def packed(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    per_bucket: int = PIECES_PER_BUCKET,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    ``vocabulary``: path of the tokenizer file on the executors; by default the installed one.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("text"))
    pieces = written(rows.mapInArrow(lambda it: tokenise(it, vocabulary, capacity), PIECE), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = plan(counts, capacity)
    buckets = sum(counts.values()) // per_bucket + 1
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    here = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = here.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        spread.withColumn("rank", (F.row_number().over(inside) - 1).cast("long"))
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("first"))
    )
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: assign(it, steps), f"{PIECE}, sequence_id long, offset long"
    )
