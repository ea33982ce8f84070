"""Trips and station capacities made ready for modelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.time import with_time_features
from dockflow.operators.endpoints import endpoint_events
from dockflow.params import MIN_TRIPS


def drop_unnamed(trips: DataFrame) -> DataFrame:
    return trips.dropna(subset=["start_station_name", "end_station_name"])


def first_by_name(stations: DataFrame, order: str = "station_id") -> DataFrame:
    """(station_name, capacity), one row per name: the first in ``order``."""
    first = Window.partitionBy("name").orderBy(order)
    return (
        stations.withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") == 1)
        .select(F.col("name").alias("station_name"), F.col("capacity").cast("double").alias("capacity"))
    )


def _valid(counts: DataFrame, min_trips: int) -> DataFrame:
    dep, arr = F.col("departures"), F.col("arrivals")
    return counts.where((dep > 0) & (arr > 0) & (dep + arr >= min_trips)).select("station_name")


def valid_stations(trips: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Stations with ``min_trips`` starts and ends in named trips. A station
    seen only at one end has no defined total and is out."""
    counts = (
        endpoint_events(drop_unnamed(trips))
        .groupBy("station_name")
        .agg(F.sum("departure").alias("departures"), F.sum("arrival").alias("arrivals"))
    )
    return _valid(counts, min_trips)


def trips_of_stations(od: DataFrame) -> DataFrame:
    """(station_name, departures, arrivals) of an origin-destination table."""
    none = F.lit(0).cast("long")
    ends = F.array(
        F.struct(F.col("from_station").alias("station_name"), F.col("trips").alias("departures"), none.alias("arrivals")),
        F.struct(F.col("to_station").alias("station_name"), none.alias("departures"), F.col("trips").alias("arrivals")),
    )
    return (
        od.select(F.inline(ends))
        .groupBy("station_name")
        .agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
    )


def valid_stations_of_od(od: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """The same from an origin-destination table, without another trip scan."""
    return _valid(trips_of_stations(od), min_trips)


def between_known(trips: DataFrame, known: DataFrame, start: str = "start_station_name", end: str = "end_station_name") -> DataFrame:
    """Rows whose both ends are in ``known`` (station_name)."""
    names = known.select("station_name")
    return (
        trips.join(names.withColumnRenamed("station_name", start), start, "left_semi")
        .join(names.withColumnRenamed("station_name", end), end, "left_semi")
        .select(*trips.columns)
    )


def station_stats(valid: DataFrame, stations: DataFrame) -> DataFrame:
    """(station_name, capacity) of the valid stations. Those without a station
    record get the median capacity of those with one."""
    known = first_by_name(stations).withColumn("listed", F.lit(True))
    joined = valid.join(known, "station_name", "left")
    # One row per station, so an exact median of it is small.
    median = joined.where("listed").agg(F.median("capacity").alias("m")).scalar()
    return joined.select(
        "station_name", F.when(F.col("listed"), F.col("capacity")).otherwise(median).alias("capacity")
    )


def prepare(trips: DataFrame, stations: DataFrame, min_trips: int = MIN_TRIPS) -> tuple[DataFrame, DataFrame]:
    """(trips between valid stations with time features, station stats)."""
    valid = valid_stations(trips, min_trips)
    kept = between_known(with_time_features(drop_unnamed(trips)), valid)
    return kept, station_stats(valid, stations)


def prepare_od(od: DataFrame, stations: DataFrame, min_trips: int = MIN_TRIPS) -> tuple[DataFrame, DataFrame]:
    """``prepare`` on an hourly origin-destination table.

    The valid stations are kept and counted first: with their size known, the
    table meets few stations without being shuffled by either end.
    """
    valid = valid_stations_of_od(od, min_trips).persist()
    valid.count()
    return between_known(od, valid, "from_station", "to_station"), station_stats(valid, stations)
