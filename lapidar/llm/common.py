"""What several operators of this subpackage share: white space, row locators, written tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.session import SHUFFLE_CLEANUP, scratch_dir

# Fixed value: the white space of all contracts, as a regular expression (Java and RE2).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Where a row lies in its Parquet file; unique per row, the same on every read.
FILE, ROW = "_llm_file", "_llm_row"
# Names that start so are this subpackage's.
RESERVED, SET_ASIDE = "_llm_", "set_aside"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared scratch folder and read again: no lineage is left.

    The shuffle files of the job go with it, as no later one can ask for them. Texts take less room in zstd.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.sparkSession.conf.set(SHUFFLE_CLEANUP, "true")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def located(docs: DataFrame) -> DataFrame:
    """Adds FILE and ROW. A frame that isn't a plain Parquet read is written first.

    Columns that are named like this subpackage's own get other names; ``own_columns`` gives theirs back.
    """
    docs = _set_aside(docs)
    for frame in (docs, None):
        frame = written(docs, "rows") if frame is None else frame
        try:
            place = frame.metadataColumn("_metadata")
            return frame.select("*", place.getField("file_path").alias(FILE), place.getField("row_index").alias(ROW))
        except AnalysisException:
            continue
    raise AnalysisException("rows of a written table have no file position")


def _set_aside(docs: DataFrame) -> DataFrame:
    taken = {c.lower() for c in docs.columns}
    columns, number = [], 0
    for name in docs.columns:
        column = quoted(name)
        if name.lower().startswith(RESERVED):
            while f"set_aside_{number}" in taken:
                number += 1
            column = column.alias(f"set_aside_{number}", metadata={SET_ASIDE: name})
            number += 1
        columns.append(column)
    return docs.select(columns) if number else docs


def own_columns(placed: DataFrame) -> list[Column]:
    """The columns of the frame that ``located`` was given, by their names."""
    fields = [f for f in placed.schema if not f.name.startswith(RESERVED)]
    return [quoted(f.name).alias(f.metadata[SET_ASIDE]) if SET_ASIDE in f.metadata else quoted(f.name) for f in fields]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of located ``docs`` whose place is not in ``dropped`` (FILE, ROW), in the columns of documents.

    An anti join; Spark broadcasts the dropped places only when their written size is under its limit.
    """
    return docs.join(dropped.select(FILE, ROW), [FILE, ROW], "left_anti").select(own_columns(docs))
