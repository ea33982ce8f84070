"""Station tables: activity ranks, identities, places, capacity use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.numeric import activity_score
from dockflow.operators.endpoints import station_activity
from dockflow.params import LAT_MAX, LAT_MIN, LNG_MAX, LNG_MIN


def busiest(activity: DataFrame, n: int = 15) -> DataFrame:
    return activity.orderBy(F.desc("total_trips"), "station_name").limit(n)


def receivers(activity: DataFrame, n: int = 10) -> DataFrame:
    return activity.orderBy(F.desc("net_flow"), "station_name").limit(n)


def senders(activity: DataFrame, n: int = 10) -> DataFrame:
    return activity.orderBy(F.asc("net_flow"), "station_name").limit(n)


def multi_id_stations(trips: DataFrame) -> DataFrame:
    """Start station names with more than one id."""
    return (
        trips.where(F.col("start_station_name").isNotNull())
        .groupBy("start_station_name")
        .agg(F.count_distinct("start_station_id").alias("n_ids"))
        .where(F.col("n_ids") > 1)
        .orderBy(F.desc("n_ids"), "start_station_name")
    )


def inside_box(lat: str, lng: str, lat_min=LAT_MIN, lat_max=LAT_MAX, lng_min=LNG_MIN, lng_max=LNG_MAX):
    """Strictly inside the bounding box."""
    lat, lng = F.col(lat), F.col(lng)
    return (lat > lat_min) & (lat < lat_max) & (lng > lng_min) & (lng < lng_max)


def station_coords(trips: DataFrame, **box: float) -> DataFrame:
    """(station_name, lat, lng): mean place over the trips that start there,
    else over those that end there; places outside the box do not count."""
    end = lambda side: F.struct(
        F.lit(side == "start").alias("is_start"),
        F.col(f"{side}_station_name").alias("station_name"),
        F.col(f"{side}_lat").alias("lat"),
        F.col(f"{side}_lng").alias("lng"),
    )
    mean = lambda col, start: F.avg(F.when(F.col("is_start") == F.lit(start), F.col(col)))
    return (
        trips.select(F.inline(F.array(end("start"), end("end"))))
        .where(inside_box("lat", "lng", **box) & F.col("station_name").isNotNull())
        .groupBy("station_name")
        .agg(
            F.coalesce(mean("lat", True), mean("lat", False)).alias("lat"),
            F.coalesce(mean("lng", True), mean("lng", False)).alias("lng"),
        )
    )


def station_locations(trips: DataFrame, **box: float) -> DataFrame:
    """Activity of the stations with a place inside the box, with its log score."""
    return (
        station_activity(trips)
        .join(station_coords(trips, **box), "station_name", "left")
        .dropna(subset=["lat", "lng"])
        .where(inside_box("lat", "lng", **box))
        .withColumn("activity", activity_score("total_trips"))
    )


def net_flow_quantile(activity: DataFrame, prob: float = 0.95) -> DataFrame:
    """Quantile of the absolute net flow over stations (one row per station)."""
    return activity.agg(F.percentile(F.abs("net_flow").cast("double"), F.lit(prob)).alias("abs_net_flow"))


def trips_per_capacity(trips: DataFrame, stations: DataFrame, year: int, month: int, n: int = 20) -> DataFrame:
    """Stations with the most trips per dock in a month, matched by station id.
    Trips are counted per id before the join; without docks there is no ratio."""
    month_trips = (
        trips.where((F.col("year") == year) & (F.col("month") == month))
        .groupBy("start_station_id", "start_station_name")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    docks = stations.where(F.col("capacity").isNotNull()).select(F.col("station_id").alias("start_station_id"), "capacity")
    return (
        month_trips.join(docks, "start_station_id")
        .groupBy("start_station_name", "capacity")
        .agg(F.sum("trips").alias("trip_count"))
        .withColumn("trips_per_capacity", F.try_divide(F.col("trip_count"), F.col("capacity")))
        .orderBy(F.desc_nulls_last("trips_per_capacity"), "start_station_name")
        .limit(n)
    )
