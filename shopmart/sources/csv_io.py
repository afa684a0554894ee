"""CSV staging: write with NULL and '' both as empty fields (the shop's CSV
has no NULL), read back with a checked header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_OPTIONS = {"nullValue": "", "emptyValue": "", "escape": '"', "quote": '"'}


def check_columns(columns: Sequence[str]) -> None:
    if len(columns) != len(set(columns)):
        raise ValueError("Column names must be unique.")


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              encoding: str = "UTF-8") -> None:
    """Distributed CSV write (one file per partition)."""
    check_columns(df.columns)
    w = df.write.mode("overwrite").option("header", header).option("sep", sep).option("encoding", encoding)
    for k, v in CSV_OPTIONS.items():
        w = w.option(k, v)
    w.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True,
                     sep: str = ",", encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Read CSV with ``schema``; with ``header`` the file's header must name
    exactly the schema's columns (Spark raises otherwise).  Empty fields are
    NULL; fields may hold quoted separators and quotes.

    Files are split over tasks.  Fields with line breaks need ``multi_line``,
    which makes each file one task; without it they fail the job.
    """
    check_columns(schema.fieldNames())
    r = (spark.read.schema(schema).option("header", header).option("enforceSchema", not header)
         .option("sep", sep).option("encoding", encoding).option("multiLine", multi_line).option("mode", "FAILFAST"))
    for k, v in CSV_OPTIONS.items():
        r = r.option(k, v)
    return r.csv(path)
