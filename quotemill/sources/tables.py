"""Scans of tables by name or path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import layer_name


def scan(spark: SparkSession, table: str) -> DataFrame:
    """Scan a catalog table; columns and filters are pruned by the plan that uses it."""
    return spark.table(table)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the database of a layer when it is absent and return its name."""
    name = layer_name(name)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return name
