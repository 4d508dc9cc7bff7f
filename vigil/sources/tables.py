"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
