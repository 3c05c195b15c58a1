"""Reading the test-table folders: ``<dir>/<name>.parquet`` per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register every table of ``sf_dir`` as a temporary view under its own name."""
    for name in names or TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
