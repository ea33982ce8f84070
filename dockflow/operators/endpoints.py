"""The endpoint unpivot and the aggregates built on it.

A trip is a departure at one station and an arrival at another, both dated by
the trip's start. One scan emits both, and the partial aggregate before the
shuffle reduces them to at most (stations x buckets) rows per task, so a
station that holds a third of all trips is no heavier than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.time import floor_to
from dockflow.params import HOUR


def endpoint_events(trips: DataFrame) -> DataFrame:
    """(started_at, station_name, departure, arrival): two rows per trip."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = F.array(
        F.struct(F.col("start_station_name").alias("station_name"), one.alias("departure"), none.alias("arrival")),
        F.struct(F.col("end_station_name").alias("station_name"), none.alias("departure"), one.alias("arrival")),
    )
    return trips.select("started_at", F.inline(ends))


def station_activity(trips: DataFrame) -> DataFrame:
    """Departures, arrivals, their total and net flow per named station."""
    return (
        endpoint_events(trips)
        .where(F.col("station_name").isNotNull())
        .groupBy("station_name")
        .agg(F.sum("departure").alias("departures"), F.sum("arrival").alias("arrivals"))
        .select(
            "station_name",
            "departures",
            "arrivals",
            (F.col("departures") + F.col("arrivals")).alias("total_trips"),
            (F.col("arrivals") - F.col("departures")).alias("net_flow"),
        )
    )


def trips_by_station(trips: DataFrame) -> DataFrame:
    """Departures and arrivals per station with unnamed starts and unnamed ends
    as two rows, which is what a full outer join of the two counts gives."""
    unnamed_side = F.when(F.col("station_name").isNull(), F.col("departure"))
    return (
        endpoint_events(trips)
        .withColumn("unnamed_side", unnamed_side)
        .groupBy("station_name", "unnamed_side")
        .agg(F.sum("departure").alias("departures"), F.sum("arrival").alias("arrivals"))
        .select(
            "station_name",
            "departures",
            "arrivals",
            (F.col("departures") + F.col("arrivals")).alias("total_trips"),
        )
        .orderBy(F.desc("total_trips"), "station_name", "departures")
    )


def flow_by_bucket(trips: DataFrame, seconds: int = HOUR) -> DataFrame:
    """(station_name, bucket, departures, arrivals, net) per time bucket."""
    return (
        endpoint_events(trips)
        .where(F.col("station_name").isNotNull())
        .groupBy("station_name", floor_to("started_at", seconds).alias("bucket"))
        .agg(F.sum("departure").alias("departures"), F.sum("arrival").alias("arrivals"))
        .withColumn("net", F.col("arrivals") - F.col("departures"))
    )


def od_by_hour(trips: DataFrame) -> DataFrame:
    """(bucket, from_station, to_station, trips): the narrow table from which
    flows, transitions and counts of named trips all derive."""
    return (
        trips.where(F.col("start_station_name").isNotNull() & F.col("end_station_name").isNotNull())
        .groupBy(
            floor_to("started_at").alias("bucket"),
            F.col("start_station_name").alias("from_station"),
            F.col("end_station_name").alias("to_station"),
        )
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def flow_from_od(od: DataFrame, by_station: bool = False) -> DataFrame:
    """The hourly flow table of an origin-destination table. ``by_station`` lays all
    rows of a station together before they are summed, and the result lies so."""
    none = F.lit(0).cast("long")
    ends = F.array(
        F.struct(F.col("from_station").alias("station_name"), F.col("trips").alias("departures"), none.alias("arrivals")),
        F.struct(F.col("to_station").alias("station_name"), none.alias("departures"), F.col("trips").alias("arrivals")),
    )
    ends = od.select("bucket", F.inline(ends))
    return (
        (ends.repartition("station_name") if by_station else ends)
        .groupBy("station_name", "bucket")
        .agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
        .withColumn("net", F.col("arrivals") - F.col("departures"))
    )


def station_names(trips: DataFrame) -> DataFrame:
    """Distinct names seen at either end."""
    return (
        endpoint_events(trips)
        .where(F.col("station_name").isNotNull())
        .select("station_name")
        .distinct()
    )


def net_flow_ranking(trips: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most imbalanced stations."""
    return (
        station_activity(trips)
        .select("station_name", "departures", "arrivals", "net_flow")
        .orderBy(F.desc(F.abs("net_flow")), "station_name")
        .limit(n)
    )
