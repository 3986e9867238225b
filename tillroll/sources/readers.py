"""Retail lines from CSV or Parquet; several inputs become one stream."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import RAW, WORKBOOK_HEADERS


def read_retail_csv(
    spark: SparkSession,
    paths: str | list[str],
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header per file; an empty field is NULL and a bad row fails the load.

    Quotes inside a quoted field are doubled. ``multi_line`` admits line breaks in fields; a
    file is then one task, so it is off unless asked for.
    """
    return (
        spark.read.schema(RAW)
        .option("header", True)
        .option("nullValue", "")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", timestamp_format)
        .csv(paths)
    )


def read_retail_parquet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else paths
    return as_raw(spark.read.parquet(*paths))


def from_workbook_headers(sheet: DataFrame) -> DataFrame:
    """One sheet under its original headers, brought to the raw names and types."""
    return as_raw(sheet.withColumnsRenamed(dict(zip(WORKBOOK_HEADERS, RAW.names))))


def as_raw(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields])


def union_sheets(sheets: Iterable[DataFrame]) -> DataFrame:
    """Row-wise concatenation by column name."""
    return reduce(DataFrame.unionByName, sheets)


def write_raw(frame: DataFrame, path: str, truncate: bool = True) -> None:
    """Store retail lines; ``truncate`` replaces what is there, otherwise rows are added."""
    as_raw(frame).write.mode("overwrite" if truncate else "append").parquet(path)
