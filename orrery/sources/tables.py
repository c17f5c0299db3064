"""Access to the driver's Parquet tables.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so callers just ``select``/``filter`` what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view for SQL use."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
