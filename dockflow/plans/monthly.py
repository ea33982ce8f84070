"""Month jobs: CSV to Parquet, and inferred inventories with their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockflow.operators.inventory import month_inventory, month_inventory_summary
from dockflow.session import cut
from dockflow.sources import results, trips


def convert_months(
    spark: SparkSession, csv_root: str, target: str, glob: str = "*.csv", first_months: int | None = None
) -> DataFrame:
    """Convert all monthly CSV parts in one job, write their manifest and return the audit table."""
    return trips.convert_observed(spark, csv_root, target, glob, first_months)


def infer_months(all_trips: DataFrame, stations: DataFrame | None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(inventory, summary) of every month, written below ``path`` if given."""
    inventory = month_inventory(all_trips, stations)
    summary = month_inventory_summary(all_trips, inventory)
    if path:
        inventory = cut(inventory)
        summary = month_inventory_summary(all_trips, inventory)
        results.write_month_inventory(inventory, path)
        results.write_month_documents(inventory, path)
        results.write_month_summary(summary, path)
    return inventory, summary
