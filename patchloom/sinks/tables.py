"""Schemas, table overwrite and preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A dotted name with every part in backticks."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create the schema ``db`` or ``catalog.db`` unless it exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def ensure_schema_of(spark: SparkSession, table: str) -> None:
    """Create the schema a two- or three-level table name lies in."""
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", location: str | None = None) -> None:
    """Replace the contents of a catalog table; ``location`` makes it external."""
    writer = df.write.mode("overwrite").format(fmt)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Print ``n`` rows. For interactive use: it evaluates the plan."""
    df.show(n, truncate)
