"""Ad-hoc selection and aggregation with plain arguments."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.time import duration_minutes, floor_to, is_weekend


def equals_all(filters: dict[str, Any] | None) -> Column:
    """All columns equal their value; a ``None`` value means IS NULL."""
    terms = [
        F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        for name, value in (filters or {}).items()
    ]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def select_where(
    trips: DataFrame,
    columns: list[str] | None = None,
    filters: dict[str, Any] | None = None,
    limit: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Chosen columns of the matching rows; ``limit`` 0 or None means all."""
    rows = trips.where(equals_all(filters))
    if order:
        rows = rows.orderBy(*[F.asc_nulls_last(c) for c in order])
    rows = rows.select(*columns) if columns else rows
    return rows.limit(limit) if limit else rows


def aggregate_trips(
    trips: DataFrame, group_by: list[str], aggregations: dict[str, str], filters: dict[str, Any] | None = None
) -> DataFrame:
    """Named SQL aggregate expressions per group, ordered by the keys, nulls last."""
    return (
        trips.where(equals_all(filters))
        .groupBy(*group_by)
        .agg(*[F.expr(expr).alias(name) for name, expr in aggregations.items()])
        .orderBy(*[F.asc_nulls_last(c) for c in group_by])
    )


def trip_stats(trips: DataFrame) -> DataFrame:
    """One row: trips, distinct stations at each end, first and last start, mean minutes."""
    return trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_distinct("start_station_name").alias("n_start_stations"),
        F.count_distinct("end_station_name").alias("n_end_stations"),
        F.min("started_at").alias("first_trip"),
        F.max("started_at").alias("last_trip"),
        F.avg(duration_minutes()).alias("avg_duration_minutes"),
    )


def hourly_od_summary(trips: DataFrame) -> DataFrame:
    """Trips and mean minutes per hour, start and end station."""
    return (
        trips.groupBy(floor_to("started_at").alias("hour"), "start_station_name", "end_station_name")
        .agg(F.count(F.lit(1)).alias("trip_count"), F.avg(duration_minutes()).alias("avg_duration_minutes"))
        .select(
            "hour",
            "start_station_name",
            "end_station_name",
            F.hour("hour").alias("hour_of_day"),
            is_weekend("hour").alias("is_weekend"),
            "trip_count",
            "avg_duration_minutes",
        )
    )
