"""Dated sinks (S7): one folder per dataset, partitioned by report date.

Dynamic partition overwrite makes a daily re-run idempotent: only the
partitions present in the new data are replaced.  Reading back prunes by
``report_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_dated(df: DataFrame, path: str, date_col: str = "report_date", fmt: str = "parquet",
                sort_within: list[str] | None = None) -> None:
    """Write ``df`` under ``path/<date_col>=…``; replaces only those dates."""
    # No repartition by date: one busy day would become one writer task.
    # Every task writes its own file per date it holds.
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


def read_dated(spark: SparkSession, path: str, dates: list[str] | None = None, fmt: str = "parquet",
               date_col: str = "report_date") -> DataFrame:
    """Read a dated dataset back, optionally only some dates (partition pruning)."""
    df = spark.read.format(fmt).option("header", "true").load(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    if dates:
        df = df.filter(df[date_col].cast("string").isin(dates))
    return df
