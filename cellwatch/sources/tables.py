"""Parquet table scans of the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; selecting ``columns`` right here keeps the ReadSchema pruned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
