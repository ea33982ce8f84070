"""Trip counts over time and by rider and vehicle type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.time import is_weekend


def _count(trips: DataFrame, **keys: Column) -> DataFrame:
    return trips.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(F.count(F.lit(1)).alias("trips"))


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return _count(trips, hour=F.hour("started_at"))


def trips_by_day(trips: DataFrame) -> DataFrame:
    return _count(trips, day_of_week=F.weekday("started_at"), day_name=F.date_format("started_at", "EEEE"))


def trips_by_date(trips: DataFrame) -> DataFrame:
    return _count(trips, date=F.to_date("started_at"))


def hourly_by_day_type(trips: DataFrame) -> DataFrame:
    return _count(trips, is_weekend=is_weekend("started_at"), hour=F.hour("started_at"))


def hour_day_matrix(trips: DataFrame) -> DataFrame:
    """Day of week by hour with zeros for the days and hours that occur but not
    together: both key sets have at most 7 and 24 members."""
    counts = _count(trips, day_of_week=F.weekday("started_at"), hour=F.hour("started_at"))
    hours = counts.agg(F.array_sort(F.collect_set("hour"))).scalar()
    cells = counts.select("day_of_week").distinct().select("day_of_week", F.explode(hours).alias("hour"))
    return cells.join(counts, ["day_of_week", "hour"], "left").select(
        "day_of_week", "hour", F.coalesce("trips", F.lit(0).cast("long")).alias("trips")
    )


def type_shares(trips: DataFrame, *columns: str) -> DataFrame:
    """(attribute, value, trips, share) of each attribute's values, from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in columns])
    counts = trips.select(F.inline(pairs)).groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("trips"))
    # One row per distinct value of a category.
    total = F.sum("trips").over(Window.partitionBy("attribute"))
    return counts.withColumn("share", F.col("trips") / total)


def user_type_hourly(trips: DataFrame) -> DataFrame:
    return _count(trips, member_casual=F.col("member_casual"), hour=F.hour("started_at"))


def user_type_daily(trips: DataFrame) -> DataFrame:
    return _count(trips, member_casual=F.col("member_casual"), day_of_week=F.weekday("started_at"))


def station_hourly(trips: DataFrame, station: str) -> DataFrame:
    """Departures of one station by hour of day."""
    return trips.where(F.col("start_station_name") == station).groupBy(F.hour("started_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("departures")
    )


def trips_per_month(trips: DataFrame) -> DataFrame:
    """Trips per (year, month) partition."""
    return trips.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trip_count"))


def missing_months(trips: DataFrame, first: str, last: str) -> DataFrame:
    """Months of [first, last] (YYYY-MM-DD) without a partition."""
    months = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH")))
    expected = trips.sparkSession.range(1).select(months.alias("m")).select(
        F.year("m").alias("year"), F.month("m").alias("month")
    )
    return expected.join(trips.select("year", "month").distinct(), ["year", "month"], "left_anti")


def daily_count_description(trips: DataFrame) -> DataFrame:
    """describe() of the trips per date."""
    return describe_small(trips_by_date(trips), "trips")


def describe_small(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles, maximum of a column
    whose row count is small (dates, stations)."""
    c = F.col(column).cast("double")
    quartile = lambda p: F.percentile(c, F.lit(p))
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        quartile(0.25).alias("q25"),
        quartile(0.5).alias("q50"),
        quartile(0.75).alias("q75"),
        F.max(c).alias("max"),
    )
