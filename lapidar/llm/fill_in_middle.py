"""Fill-in-the-middle transformation of whole texts by secondary-sort assembly.

A text is cut into lines, and a hash of the document's id and a seed says where prefix and middle
end. Each part leaves its task as pieces of whole lines, keyed by the row and the piece's position
in the output; ``repartitionAndSortWithinPartitions`` brings the pieces of a row together in output
order, where they stream through the digest of the output. The same stream is read back: the
sentinels part it again, its pieces get their position in the text and are sorted once more (their
partitions stay, so nothing is shuffled a second time) to stream through the digest of the restored
text. No task holds more of a document than a piece, apart from the row that it reads; what doesn't
fit in memory is sorted on disk.

Rows are keyed by their place in the input, so documents that share a doc_id, even very many, are
dealt over all partitions.

Defined results: a null or empty text has no lines, is ``plain`` and comes back empty; so is a text
that holds a sentinel, whole; a null doc_id is hashed like an empty one (``7:``); repeated rows give
equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import located, text_of

# The sentinels and the outputs' order of parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
PARTS = (PREFIX, MIDDLE, SUFFIX)  # as they stand in the text
PIECE = 1 << 16
# Bytes of text of a partition; adaptive execution doesn't size the shuffles of an RDD.
PARTITION = 1 << 27
ROWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    percent: int = 100  # of documents that are transformed
    spm_percent: int = 50  # of these, with the suffix first
    piece: int = PIECE  # code points of a piece


class Cut(NamedTuple):
    """How a text is transformed: lines, form, and the ends of prefix and middle in code points."""

    n: int
    form: str
    prefix_end: int
    middle_end: int


def line_ends(text: str) -> list[int]:
    """Ends of the lines; a last line may lack its line feed."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def decided(doc_id: int | None, text: str, ends: list[int], settings: Settings) -> Cut:
    digest = hashlib.sha256(f"{settings.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))
    n = len(ends)
    if not text or any(s in text for s in PARTS) or h3 % 100 >= settings.percent:
        return Cut(n, PLAIN, 0, 0)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [0, *ends]
    return Cut(n, "spm" if h4 % 100 < settings.spm_percent else "psm", at[first], at[second])


def pieces(text: str, ends: list[int], start: int, stop: int, most: int) -> Iterator[str]:
    """The text from start to stop (ends of lines) in pieces of whole lines; a line above ``most`` is cut."""
    at = start
    for end in [*ends, stop]:
        if end <= at or end > stop:
            continue
        if end - start > most and at > start:
            yield text[start:at]
            start = at
        while end - start > most:
            yield text[start : start + most]
            start += most
        at = end
    if start < stop:
        yield text[start:stop]


def assembled(text: str, ends: list[int], cut: Cut, most: int = PIECE) -> Iterator[str]:
    """The output, piece by piece."""
    if cut.form == PLAIN:
        yield from pieces(text, ends, 0, len(text), most)
        return
    spans = {PREFIX: (0, cut.prefix_end), MIDDLE: (cut.prefix_end, cut.middle_end), SUFFIX: (cut.middle_end, len(text))}
    for sentinel in SENTINELS[cut.form]:
        yield sentinel
        yield from pieces(text, ends, *spans[sentinel], most)


def parted(output: Iterable[str], form: str) -> Iterator[tuple[int, str]]:
    """Pieces of the output without its sentinels, each with the rank of its part in the text.

    Only the output and its form are known here; a sentinel may lie across two pieces.
    """
    if form == PLAIN:
        yield from ((0, piece) for piece in output)
        return
    ahead, part, rest = list(SENTINELS[form]), 0, ""
    for piece in output:
        rest += piece
        while ahead and (at := rest.find(ahead[0])) >= 0:
            if at:
                yield part, rest[:at]
            part, rest = PARTS.index(ahead[0]), rest[at + len(ahead.pop(0)) :]
        # what could be the start of the next sentinel waits for the next piece
        keep = next((k for k in range(min(len(rest), 2), 0, -1) if ahead and ahead[0].startswith(rest[-k:])), 0)
        if len(rest) > keep:
            yield part, rest[: len(rest) - keep]
            rest = rest[len(rest) - keep :]
    if rest:
        yield part, rest


def restored(output: Iterable[str], form: str) -> str:
    """The text of an output that fits in memory."""
    return "".join(piece for _, piece in sorted(parted(output, form), key=lambda x: x[0]))


def _row_partition(key: tuple) -> int:
    (part, row), _ = key
    return (part * 0x9E3779B1 + row * 0x85EBCA6B) >> 7


def _emitted(part: int, rows: Iterator, settings: Settings) -> Iterator[tuple]:
    """((row, position), piece): the first of a row holds what is known of it."""
    for i, (doc_id, text) in enumerate(rows):
        ends = line_ends(text)
        cut = decided(doc_id, text, ends, settings)
        plain = cut.form == PLAIN
        known = (doc_id, cut.n, cut.form, None if plain else cut.prefix_end, None if plain else cut.middle_end - cut.prefix_end)
        yield ((part, i), 0), known
        for position, piece in enumerate(assembled(text, ends, cut, settings.piece), 1):
            yield ((part, i), position), piece


def _by_row(records: Iterator[tuple]) -> Iterator[tuple]:
    """key, first record, and an iterator of the others for each row of a sorted stream."""
    ahead = next(records, None)
    while ahead is not None:
        (key, _), first = ahead
        ahead = None

        def others() -> Iterator[str]:
            nonlocal ahead
            for record in records:
                if record[0][0] != key:
                    ahead = record
                    return
                yield record[1]

        rest = others()
        yield key, first, rest
        for _ in rest:  # nothing is left of this row where the caller has read it all
            pass


def _digested(records: Iterator[tuple]) -> Iterator[tuple]:
    """The output's digest of each row, and its pieces keyed by their place in the text."""
    for key, known, output in _by_row(records):
        digest = hashlib.sha256()

        def read(output: Iterator[str] = output, digest=digest) -> Iterator[str]:
            for piece in output:
                digest.update(piece.encode("utf-8", "replace"))
                yield piece

        for order, (part, piece) in enumerate(parted(read(), known[2])):
            yield (key, (part, order)), piece
        yield (key, (-1, 0)), (*known, digest.hexdigest())


def _restored(records: Iterator[tuple]) -> Iterator[tuple]:
    for _, known, text in _by_row(records):
        digest = hashlib.sha256()
        for piece in text:
            digest.update(piece.encode("utf-8", "replace"))
        yield (*known, digest.hexdigest())


def outputs(docs: DataFrame, settings: Settings = Settings(), partitions: int | None = None) -> RDD:
    """((row, position), value) sorted within partitions: per row what is known of it, then the output's pieces.

    ``partitions``: by default so many that each gets about ``PARTITION`` bytes of text, one for each core at least.
    """
    rows = located(docs).select(F.col("doc_id").cast("long"), text_of().alias("text"))
    if partitions is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        partitions = max(-(-size // PARTITION), rows.sparkSession.sparkContext.defaultParallelism)
    emitted = rows.rdd.mapPartitionsWithIndex(lambda part, it: _emitted(part, it, settings))
    return emitted.repartitionAndSortWithinPartitions(partitions, _row_partition)


def transformed(spark: SparkSession, docs: DataFrame, settings: Settings = Settings(), partitions: int | None = None) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, and the digests of output and restored text."""
    sorted_ = outputs(docs, settings, partitions)
    again = sorted_.mapPartitions(_digested, preservesPartitioning=True)
    again = again.repartitionAndSortWithinPartitions(sorted_.getNumPartitions(), _row_partition)
    return spark.createDataFrame(again.mapPartitions(_restored), ROWS, verifySchema=False)


def texts(spark: SparkSession, docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, form, position, piece of the outputs: what a writer of training shards takes, in order within partitions."""

    def rows(records: Iterator[tuple]) -> Iterator[tuple]:
        for _, known, output in _by_row(records):
            for position, piece in enumerate(output):
                yield known[0], known[2], position, piece

    return spark.createDataFrame(
        outputs(docs, settings).mapPartitions(rows), "doc_id long, form string, position long, piece string", verifySchema=False
    )
