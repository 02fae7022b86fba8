"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PARTITION = ("year", "month")
# Quotes are doubled inside quoted fields, and padding is written as it is.
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _laid_out(df: DataFrame, by: Sequence[str], clustered: bool) -> DataFrame:
    """Rows of one partition brought together before a partitioned write.

    REBALANCE lets AQE cut a large year/month into many advisory-size tasks and join small ones, so
    neither does one task write a whole month nor does every task write one file per month. Input that
    is ``clustered`` already (monthly source files) needs no shuffle and is written as it comes.
    """
    return df if clustered else df.hint("rebalance", *by)


def write_curated(
    df: DataFrame, path: str, by: Sequence[str] = PARTITION, fmt: str = "orc", clustered: bool = False
) -> None:
    """Partitioned columnar write that replaces what was there."""
    _laid_out(df, by, clustered).write.partitionBy(*by).mode("overwrite").format(fmt).save(path)


def insert_curated(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    by: Sequence[str] = PARTITION,
    fmt: str = "orc",
    clustered: bool = False,
) -> None:
    """Insert into a partitioned table. ``overwrite`` replaces only the partitions present in ``df``."""
    writer = _laid_out(df, by, clustered).write.partitionBy(*by).format(fmt)
    if overwrite:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").save(path)
    else:
        writer.mode("append").save(path)


def save_result(df: DataFrame, name: str, path: str | None = None, fmt: str = "orc") -> None:
    """Create a table from a query."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_text(df: DataFrame, path: str, fmt: str = "csv", header: bool = False) -> None:
    """CSV (fields quoted where needed), JSON lines, or plain text of one column."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**_CSV, header=header).csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "text":
        writer.text(path)
    else:
        raise ValueError(f"unknown text format: {fmt}")


def compact(df: DataFrame, path: str, rows_per_file: int = 5_000_000, fmt: str = "orc") -> None:
    """Many small part files into few: AQE merges partitions up to the advisory size.

    Not one file: a single output task would have to carry the whole table.
    """
    writer = df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.options(**_CSV, header=True) if fmt == "csv" else writer).format(fmt).save(path)


def register(
    spark: SparkSession, name: str, path: str, schema: str, by: Sequence[str] = PARTITION, fmt: str = "orc"
) -> DataFrame:
    """External table over existing partition folders; returns its partition list."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING {fmt} PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.sql(f"SHOW PARTITIONS {name}")
