"""Stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.versions import Versions

# Names under which reports in SQL see the star tables.
STAR_VIEWS = {
    "sales_fact": "sf",
    "customer_dim": "cd",
    "product_dim": "pd",
    "store_dim": "std",
    "supplier_dim": "sud",
}


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables of a folder, or of its published version if it has one; Spark prunes columns
    and pushes filters into each scan."""
    versions = Versions(spark, folder)
    if versions.current():
        return versions.read(names)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def register_views(
    tables: Mapping[str, DataFrame], views: Mapping[str, str] = STAR_VIEWS
) -> None:
    """Make tables visible to ``spark.sql`` under short names."""
    for table, view in views.items():
        tables[table].createOrReplaceTempView(view)
