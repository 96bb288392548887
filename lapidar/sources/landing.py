"""Landing files: JDBC extraction, CSV writing and raw CSV reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from lapidar.sources.schemas import raw_schema


# A quote inside a quoted value is doubled; blanks around values belong to the values.
CSV = {
    "header": "true",
    "sep": ",",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Column with the text of a malformed row; NULL in all others.
MALFORMED = "_linha_invalida"


def read_raw_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headered CSV as text. Fails when the header does not carry the schema's names in order."""
    return spark.read.options(**CSV).option("enforceSchema", False).schema(schema).csv(path)


def landing_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/{table}_raw.csv"


def read_landing(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_raw_csv(spark, landing_path(root, table), raw_schema(table))


def marked(reader: DataFrameReader | DataStreamReader, table: str) -> DataFrameReader | DataStreamReader:
    """A reader of raw CSV that puts the text of rows with too many or too few fields into ``MALFORMED``.

    Such a row's fields can't be told apart; without the column, Spark cuts or fills the row in silence.
    """
    schema = StructType([*raw_schema(table), StructField(MALFORMED, StringType())])
    options = {**CSV, "enforceSchema": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    return reader.options(**options).schema(schema)


def read_landing_marked(spark: SparkSession, root: str, table: str) -> DataFrame:
    return marked(spark.read, table).csv(landing_path(root, table))


def write_landing(df: DataFrame, root: str, table: str) -> str:
    """Replace the landing copy of a table: a folder of headered CSV parts, compressed.

    Readers split the files at line ends, so a value with a line break fails the write.
    """
    path = landing_path(root, table)
    for column in (f.name for f in df.schema if isinstance(f.dataType, StringType)):
        broken = F.raise_error(F.concat(F.lit(f"{table}.{column} holds a line break: "), F.col(column)))
        df = df.withColumn(column, F.when(F.col(column).rlike("[\\r\\n]"), broken).otherwise(F.col(column)))
    # a compressed file is read by one task: none gets more rows than one should have
    packed = {"compression": "gzip", "maxRecordsPerFile": 5_000_000}
    df.write.mode("overwrite").options(**CSV, **packed).csv(path)
    return path


def assert_not_empty(df: DataFrame, table: str) -> DataFrame:
    """Raise when the table has no row; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"table {table!r} is empty; check the step that fills it")
    return df


def extract_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    **options: str,
) -> DataFrame:
    """A whole database table over JDBC, read in parallel by ranges of ``key``.

    Key, bounds and the number of partitions are required: without them one task would
    pull the table. Rows outside the bounds belong to the first and the last range.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
    )
    return assert_not_empty(reader.options(**options).load(), table)
