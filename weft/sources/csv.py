"""CSV and any-format table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.clean import parse_dates

_RAW = "_raw"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    parse_date_columns: list[str] | None = None,
    date_format: str | None = None,
    sep: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header; a missing path is an error. Give a schema to avoid the inference pass.

    A quote inside a quoted field is doubled. With ``multi_line`` quoted fields
    may hold line breaks; such a file is not split. Other options go to the reader.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    reader = reader.option("escape", '"').option("multiLine", multi_line).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = trim_names(reader.csv(path))
    return parse_dates(df, parse_date_columns, date_format) if parse_date_columns else df


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def decimal_number(column: str, mark: str = ",") -> Column:
    """Text with a decimal mark to double; null when it is not a number."""
    return F.expr(f"try_cast(replace(`{column}`, '{mark}', '.') AS DOUBLE)")


def scan_csv_dialect(
    spark: SparkSession,
    path: str,
    columns: list[str],
    sep: str = ";",
    decimal: str = ",",
    decimal_columns: list[str] | None = None,
    encoding: str = "utf-8",
    header: bool = True,
    **options: str,
) -> DataFrame:
    """Text columns of a CSV dialect.

    Lines with too many fields, blank ones counted, are skipped; short ones are
    padded with nulls. The parser keeps the text of any line of another length,
    and its fields are counted outside quotes.
    """
    wanted = [c.strip() for c in columns]
    fields = [StructField(c, StringType()) for c in [*wanted, _RAW]]
    raw = (
        spark.read.schema(StructType(fields))
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", _RAW)
        .option("columnPruning", False)
        .options(**options)
        .csv(path)
    )
    bare = F.regexp_replace(_RAW, '"[^"]*"', "")  # a doubled quote ends one quoted span and opens the next
    marks = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)
    # the reader does not give the raw text alone, so the filter reads a field too (a length is never negative)
    fields_read = F.length(F.coalesce(F.col(f"`{wanted[0]}`"), F.lit(""))) >= 0
    kept = raw.where(fields_read & (F.col(_RAW).isNull() | (marks < len(wanted)))).drop(_RAW)
    return kept.withColumns({c: decimal_number(c, decimal) for c in decimal_columns or []})


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Any format Spark reads."""
    return spark.read.format(fmt).options(**options).load(path)


def sample_rows(df: DataFrame, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """A fixed pseudo-random choice of n rows, or the whole table when it has no more."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)
