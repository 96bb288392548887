"""Layered tables as Parquet folders.

Bronze tables are rows of appended batches, each in a folder ``_lote=<label>`` that batch
jobs and streams write alike; writing a batch again replaces it. Every other table is a row of numbered
folders ``_v=<n>``: a load writes a new folder and never touches one that readers
may hold open. Spark writes ``_SUCCESS`` as the last step of the job, and only
folders that have it count, so a load that dies half-way leaves nothing visible
and can simply run again.

A table may be split by a label, a folder level of its own. A load then writes only the
parts it replaces; the other parts stay where the earlier load put them. Of the
old contents nothing is moved or copied. One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.functions.hashes import restored, shortened

# Hashes and amounts take about a third less room than with Spark's default.
CODEC = "zstd"
PART = "_part"
VERSION = "_v"
REPLACED = "_replaced"
BATCH = "_lote"
_ALL = ""


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder, addressed by layer and name."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    # -- reading ---------------------------------------------------------------

    def exists(self, layer: str, table: str) -> bool:
        path = self.path(layer, table)
        return bool(self._batches(path)) or bool(self._glob(f"{path}/{VERSION}=*/_SUCCESS"))

    def read(self, layer: str, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The current contents; ``parts`` restricts the scan to those folders."""
        path = self.path(layer, table)
        if batches := self._batches(path):
            return self.spark.read.parquet(*batches)
        current = self._current(path)
        if parts is not None:
            wanted = set(parts)
            current = {p: v for p, v in current.items() if p in wanted}
        if not current:
            raise FileNotFoundError(f"no data for {layer}.{table} below {path}")
        folders = [f"{path}/{VERSION}={v}" + (f"/{PART}={p}" if p else "") for p, v in current.items()]
        return self.spark.read.parquet(*folders)

    def parts(self, layer: str, table: str) -> list[str]:
        return sorted(self._current(self.path(layer, table)))

    def part_bytes(self, layer: str, table: str) -> dict[str, int]:
        """Part label -> bytes of its files."""
        path, sizes = self.path(layer, table), {}
        for part, version in self._current(path).items():
            fs, folder = self._fs(f"{path}/{VERSION}={version}" + (f"/{PART}={part}" if part else ""))
            sizes[part] = fs.getContentSummary(folder).getLength()
        return sizes

    # -- writing ---------------------------------------------------------------

    def append(self, df: DataFrame, layer: str, table: str, batch: str | None = None) -> None:
        """Add a batch; other batches are never rewritten, one with the same label is replaced."""
        label = batch or uuid.uuid4().hex
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path(layer, table)}/{BATCH}={label}")

    def read_batch(self, layer: str, table: str, *batches: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path(layer, table)}/{BATCH}={b}" for b in batches])

    def batches(self, layer: str, table: str) -> list[str]:
        """Labels of the finished batches."""
        return sorted(p.rsplit(f"{BATCH}=", 1)[1] for p in self._batches(self.path(layer, table)))

    def has_batch(self, layer: str, table: str, batch: str) -> bool:
        return bool(self._glob(f"{self.path(layer, table)}/{BATCH}={batch}/_SUCCESS"))

    def remove_batches(self, layer: str, table: str) -> None:
        """Delete a table of batches that its job wrote for itself only."""
        fs, folder = self._fs(self.path(layer, table))
        fs.delete(folder, True)

    def publish(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the whole table."""
        path = self.path(layer, table)
        df.write.option("compression", CODEC).parquet(f"{path}/{VERSION}={self._next_version(path)}")

    def publish_parts(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        part: Column,
        replaced: Iterable[str],
        hashes: Iterable[str] = (),
        finish: Callable[[DataFrame], DataFrame] | None = None,
        unmoved: DataFrame | None = None,
        more: int | None = None,
        last: bool = True,
    ) -> None:
        """Replace the named parts by the rows of ``df``.

        The rebalance hint gathers each part into files of the advisory size and
        spreads a part that is too large for one task over several. ``hashes`` names
        columns of mostly hash texts, which go to these tasks in half their bytes;
        ``df`` may have them shortened already. ``finish`` makes the table's rows of ``df``'s
        there. ``unmoved`` are rows of the table that are gathered by part already: they are
        written where they are read. A version may be written in several calls: those before the
        ``last`` leave it invisible, those after the first name it (``more``).
        """
        path = self.path(layer, table)
        folder = f"{path}/{VERSION}={more or self._next_version(path)}"
        for label in ["none", *replaced]:
            # tells readers which earlier parts this version supersedes, also where
            # it has no rows for them
            self._mkdirs(f"{folder}/{REPLACED}={label}")
        rows = self.gathered(df, part, hashes)
        if finish is not None:
            rows = finish(rows).withColumn(PART, part)
        if unmoved is not None:
            rows = rows.unionByName(unmoved.withColumn(PART, part))
        write = rows.write.mode("append").option("compression", CODEC)
        if not last:
            write = write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        write.partitionBy(PART).parquet(folder)

    def gathered(self, df: DataFrame, part: Column, hashes: Iterable[str] = ()) -> DataFrame:
        """The rows with their part, those of a part in as few tasks as its size needs."""
        return restored(shortened(df.withColumn(PART, part), hashes).hint("rebalance", PART), hashes)

    def compact(self, layer: str, table: str) -> None:
        """Rewrite small files into few; the rows stay the same.

        A split table is compacted part by part, so no part changes its place.
        """
        current = self._current(self.path(layer, table))
        if set(current) <= {_ALL}:
            self.publish(self.read(layer, table).hint("rebalance"), layer, table)
            return
        path = self.path(layer, table)
        folders = [f"{path}/{VERSION}={v}/{PART}={p}" for p, v in current.items()]
        df = self.spark.read.option("basePath", path).parquet(*folders).drop(VERSION)
        self.publish_parts(df, layer, table, F.col(PART).cast("string"), current)

    def file_count(self, layer: str, table: str) -> int:
        return len(self.read(layer, table).inputFiles())

    def version(self, layer: str, table: str) -> int:
        """The number of the last finished write of the table; 0 before the first."""
        return max((_version(p) for p in self._glob(f"{self.path(layer, table)}/{VERSION}=*/_SUCCESS")), default=0)

    def next_version(self, layer: str, table: str) -> int:
        """The number that the next write of the table gets."""
        return self._next_version(self.path(layer, table))

    def _batches(self, path: str) -> list[str]:
        """Folders of the finished batches."""
        return [p.rsplit("/", 1)[0] for p in self._glob(f"{path}/{BATCH}=*/_SUCCESS")]

    # -- folder names ----------------------------------------------------------

    def _current(self, path: str) -> dict[str, int]:
        """Part label -> version that holds it, over the finished versions only."""
        done = {_version(p) for p in self._glob(f"{path}/{VERSION}=*/_SUCCESS")}
        whole = set(done)
        dropped: dict[int, set[str]] = {}
        present: dict[int, set[str]] = {}
        for folder, found in ((REPLACED, dropped), (PART, present)):
            for p in self._glob(f"{path}/{VERSION}=*/{folder}=*"):
                found.setdefault(_version(p), set()).add(p.rsplit("=", 1)[1])
                whole.discard(_version(p))
        current: dict[str, int] = {}
        for v in sorted(done):
            if v in whole:
                current = {_ALL: v}
                continue
            for label in dropped.get(v, ()):
                current.pop(label, None)
            current.update(dict.fromkeys(present.get(v, ()), v))
        return current

    def _next_version(self, path: str) -> int:
        return max((_version(p) for p in self._glob(f"{path}/{VERSION}=*")), default=0) + 1

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _glob(self, pattern: str) -> list[str]:
        fs, hadoop_path = self._fs(pattern)
        return [s.getPath().toString() for s in fs.globStatus(hadoop_path) or []]

    def _mkdirs(self, path: str) -> None:
        fs, hadoop_path = self._fs(path)
        fs.mkdirs(hadoop_path)


def _version(path: str) -> int:
    return int(re.search(rf"/{VERSION}=(\d+)", path).group(1))
