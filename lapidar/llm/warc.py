"""WARC archives with a two-level capture index.

Archives are plain WARC 1.1 files. Spark's text sink writes them: a record is one value and the
two line ends that close a WARC record are the line separator, so a failed task leaves no file.
The index follows the captures: keys with the host reversed are sorted into compressed blocks of
a few thousand lines, and a sparse directory keeps each block's first key. A lookup goes to the
part of the index that holds its key, binary-searches the directory, opens the block, binary-searches
the lines, and the record is read by its range from the archive.

Archives and range reads need a shared folder that pyarrow can open (local, S3, GCS, HDFS).

Defined results: a null html is an empty payload; a null url has the key ``-`` and no target header;
of equal payloads the smallest page_id is the response (all rows that repeat it), rows without
page_id come last; every row gives one record and one row back; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import text_of, written
from lapidar.llm.url_filter import host_of
from lapidar.session import scratch_dir

# WARC 1.1 and RFC 4648.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
WHEN = "1970-01-01T00:00:00Z"
LEAST_BYTES = 0
RECORDS_PER_FILE = 4096
LINES_PER_BLOCK = 3000
CAPTURES_PER_PART, MOST_PARTS = 200_000, 10_000
CAPTURE = "key string, file string, offset long, length long"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four characters."""
    digest, signs = F.sha1(text.cast("binary")), []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        signs += [
            F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)
        ]
    return F.concat(*signs)


def key_of(url: Column) -> Column:
    """Host reversed by its labels, then what follows it without the fragment: ``org,example,www)/path?query``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    labels = F.array_join(F.reverse(F.split(host_of(url), r"\.")), ",")
    key = F.when(F.instr(url, "://") > 0, F.concat(labels, F.lit(")"), rest)).otherwise(url)
    return F.regexp_replace(F.coalesce(key, F.lit("-")), r"[\x00-\x20]", "_")


def judged(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, bytes, digest and ``first``: the page whose payload this one repeats, or null."""
    rows = pages.select("page_id", "url", text_of("html").alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": base32_sha1(F.col("html"))})
    groups = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
    )
    # only payloads that repeat: Spark broadcasts them if their written size is under its limit
    repeats = written(groups.select("digest", "bytes", "first"), "payloads")
    again = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(repeats, ["digest", "bytes"], "left").withColumn("first", F.when(again, F.col("first")))


def record(when: str = WHEN) -> Column:
    """The WARC record of a judged page, without the line ends that close it."""
    again = F.col("first").isNotNull()
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END)
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), page("page_id")),
        F.lit(f"WARC-Date: {when}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), page("first"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    )
    return F.concat(lines, F.lit(END), block)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, per_file: int = RECORDS_PER_FILE) -> None:
    records = judged(pages, least_bytes).select(record().alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(folder)


def _headers(head: bytes) -> dict[str, str]:
    """Only the one space after the colon goes: white space at the ends of a url is part of its key."""
    pairs = (line.split(b":", 1) for line in head.split(b"\r\n")[1:])
    return {k.decode().lower(): v.removeprefix(b" ").decode("utf-8", "replace") for k, v in pairs}


def _scan(content: memoryview | bytes) -> Iterator[tuple[dict[str, str], int, int]]:
    """Headers, offset and length of each record of an archive."""
    content, at = bytes(content), 0
    while at < len(content):
        body = content.index(END.encode(), at) + len(END)
        headers = _headers(content[at : body - len(END)])
        length = body - at + int(headers["content-length"]) + len(END)
        yield headers, at, length
        at += length


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["url", "file", "offset", "length"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows = [(h.get("warc-target-uri"), path, at, n) for h, at, n in _scan(content.as_buffer())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] or [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """key, file, offset and length of every record of the archives in a folder."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")
    found = files.mapInArrow(_captures, "url string, file string, offset long, length long")
    return found.select(key_of(F.col("url")).alias("key"), "file", "offset", "length")


def _line(key: str, file: str, offset: int, length: int) -> str:
    return f"{key}\t{file}\t{offset}\t{length}"


def _blocks(batches: Iterator[pa.RecordBatch], lines_per_block: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("lines", pa.binary())])
    from pyspark import TaskContext

    part, rows = TaskContext.get().partitionId(), []

    def out() -> pa.RecordBatch:
        text = "\n".join(_line(*r) for r in rows).encode()
        row = {"part": part, "first": rows[0][0], "last": rows[-1][0], "lines": zlib.compress(text)}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")), strict=True):
            rows.append(row)
            if len(rows) == lines_per_block:
                yield out()
                rows = []
    if rows:
        yield out()


def build_index(
    found: DataFrame, per_part: int = CAPTURES_PER_PART, most_parts: int = MOST_PARTS, lines_per_block: int = LINES_PER_BLOCK
) -> DataFrame:
    """part, first, last, lines: sorted captures in compressed blocks, written.

    The sort has place and offset as further keys, so one key with many captures spreads over parts.
    """
    found = written(found, "captures")
    parts = min(found.count() // per_part + 1, most_parts)
    order = ["key", "file", "offset"]
    placed = found.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(
        placed.mapInArrow(lambda it: _blocks(it, lines_per_block), "part int, first string, last string, lines binary"), "cdx"
    )


def _route(batches: Iterator[pa.RecordBatch], parts: list[tuple[str, str, int]]) -> Iterator[pa.RecordBatch]:
    lasts = [last for _, last, _ in parts]
    for batch in batches:
        rows = []
        for key in batch.column("key").to_pylist():
            at = bisect.bisect_left(lasts, key)
            while at < len(parts) and parts[at][0] <= key:
                rows.append((parts[at][2], key))
                at += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())], names=["part", "key"]
        )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's blocks come first, then the keys looked up in it, in order."""
    part, firsts, blocks = None, [], []

    @functools.lru_cache(maxsize=2)
    def opened(_part: int, i: int) -> tuple[list[str], list[str]]:
        lines = zlib.decompress(blocks[i]).decode().split("\n")
        return lines, [x.split("\t", 1)[0] for x in lines]

    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["part"] != part:
                part, firsts, blocks = row["part"], [], []
            if row["lines"] is not None:
                firsts.append(row["key"])
                blocks.append(row["lines"])
                continue
            key = row["key"]
            i = max(bisect.bisect_left(firsts, key) - 1, 0)
            while i < len(firsts) and firsts[i] <= key:
                lines, keys = opened(part, i)
                for line in lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]:
                    _, file, offset, length = line.split("\t")
                    found.append((key, file, int(offset), int(length)))
                i += 1
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] or [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "file", "offset", "length"])


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """key, file, offset, length of every capture of the distinct ``keys`` (column key).

    The driver holds two keys for each part of the index, of which there is a bounded number.
    """
    ranges = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()
    parts = sorted((r["first"], r["last"], r["part"]) for r in ranges)
    asked = keys.mapInArrow(lambda it: _route(it, parts), "part int, key string")
    both = index.select("part", F.col("first").alias("key"), "lines").unionByName(
        asked.withColumn("lines", F.lit(None).cast("binary"))
    )
    return (
        both.repartitionByRange(max(len(parts), 1), "part")
        .sortWithinPartitions("part", F.col("lines").isNull(), "key")
        .mapInArrow(_search, CAPTURE)
    )


@functools.lru_cache(maxsize=4)
def _opened(path: str):
    system, inside = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(inside)


def _number(urn: str | None) -> int | None:
    inside = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if inside in ("", "none") else int(inside)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges to records; the digest and the size of a payload that is there are computed and checked."""
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        rows = []
        for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
            raw = _opened(file).read_at(length, offset)
            head, _, rest = raw.removesuffix(END.encode()).partition(END.encode())
            http, _, payload = rest.partition(END.encode())
            warc, size = _headers(head), int(_headers(http)["content-length"])
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            if warc["warc-type"] == "response":
                if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"{file} at {offset}: payload differs from its header")
            else:
                payload = None
            page, first = _number(warc["warc-record-id"]), _number(warc.get("warc-refers-to"))
            rows.append((page, warc.get("warc-target-uri"), payload, size, digest, warc["warc-type"], first))
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] or [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def read_records(found: DataFrame, tasks: int) -> DataFrame:
    """RECORD of every capture, read by range; neighbours in a file are read together.

    ``tasks``: about one for each archive, as the places are small and what they name is not.
    """
    return found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(_read, RECORD)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the pages, indexes the archives, looks every url up and reads its records."""
    folder = scratch_dir(spark, "llm-warc")
    write_archives(pages, folder)
    index = build_index(captures(spark, folder))
    keys = pages.select(key_of(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")).alias("key")).distinct()
    archives = spark.read.format("binaryFile").load(folder).select("path").count()
    return read_records(lookup(index, keys), max(archives, 1))
