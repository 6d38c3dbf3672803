"""Readers: parquet tables, CSV with a stated schema, partitioned JDBC."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# The column for lines that could not be read, see `csv_lines`.
UNREADABLE = "unreadable_line"


def parquet_table(
    spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None,
) -> DataFrame:
    """Table `name` of a folder of parquet tables, lazily.

    With the columns stated no job has to open the files to find them out.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line. The schema is stated: inferring it reads the data twice."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def csv_lines(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """CSV whose lines may be broken: `unreadable_line` holds the text of a line with too few or too many
    fields, or with a field that is not of its type, and is NULL for the others."""
    kept = StructType([*schema.fields, StructField(UNREADABLE, StringType())])
    return (
        # A line read in part would not be found broken.
        spark.read.schema(kept).option("columnPruning", False)
        .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREADABLE)
        .csv(path)
    )


def key_range_predicates(column: str, prefix: str, parts: int) -> list[str]:
    """`parts` WHERE clauses that split hexadecimal ids below `prefix` into ranges.

    Ranges on the key itself, so each connection reads its share by index. The
    first and last range are open, and NULL keys go to the first, so no row is
    left out whatever the ids look like.
    """
    if parts <= 1:
        return ["1 = 1"]
    bounds = [f"{prefix}{(i << 16) // parts:04x}" for i in range(1, parts)]
    first = f"{column} < '{bounds[0]}' OR {column} IS NULL"
    middle = [f"{column} >= '{lo}' AND {column} < '{hi}'" for lo, hi in zip(bounds, bounds[1:])]
    return [first, *middle, f"{column} >= '{bounds[-1]}'"]


def jdbc_table(
    spark: SparkSession, url: str, table: str, parts: int = 64,
    key: str = "device_id", prefix: str = "DEV-", properties: dict | None = None,
) -> DataFrame:
    """A database table (or parenthesised query), one connection per key range."""
    predicates = key_range_predicates(key, prefix, parts)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
