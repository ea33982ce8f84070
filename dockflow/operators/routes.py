"""Origin-destination routes: counts, concentration, diversity, probabilities.

Questions about the distribution of route counts run on its histogram
(count -> number of routes). N trips allow at most sqrt(2N) distinct counts, so
the histogram stays small whatever the number of routes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow.operators.endpoints import station_activity, station_names
from dockflow.operators.prepare import between_known, drop_unnamed


def od_counts(trips: DataFrame) -> DataFrame:
    """(start_station_name, end_station_name, count) of the named trips."""
    return (
        drop_unnamed(trips)
        .groupBy("start_station_name", "end_station_name")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_routes(od: DataFrame, n: int = 20) -> DataFrame:
    return od.orderBy(F.desc("count"), "start_station_name", "end_station_name").limit(n)


def self_loops(od: DataFrame) -> DataFrame:
    """Stations with round trips, their trips and share of all trips in percent."""
    loop = F.col("start_station_name") == F.col("end_station_name")
    trips = F.coalesce(F.sum(F.when(loop, F.col("count"))), F.lit(0))
    return od.agg(
        F.count_if(loop).alias("self_loop_stations"),
        trips.alias("self_loop_trips"),
        (trips * F.lit(100.0) / F.sum("count")).alias("self_loop_pct"),
    )


def count_histogram(od: DataFrame) -> DataFrame:
    """(count, routes)."""
    return od.groupBy("count").agg(F.count(F.lit(1)).alias("routes"))


def describe_route_counts(od: DataFrame) -> DataFrame:
    """describe() of the route counts, from their histogram."""
    c, w = F.col("count").cast("double"), F.col("routes")
    n, mean = F.sum(w), F.max("mean")
    quartile = lambda p: F.percentile(c, F.lit(p), w)
    # Deviations from the mean, which the histogram's rows get first: squares of counts would lose their digits.
    whole = Window.partitionBy(F.lit(1))
    centred = count_histogram(od).withColumn("mean", F.sum(c * w).over(whole) / F.sum(w).over(whole))
    variance = F.try_divide(F.sum((c - F.col("mean")) * (c - F.col("mean")) * w), n - 1)
    return centred.agg(
        n.alias("count"),
        mean.alias("mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"),
        F.min(c).alias("min"),
        quartile(0.25).alias("q25"),
        quartile(0.5).alias("q50"),
        quartile(0.75).alias("q75"),
        F.max(c).alias("max"),
    )


def _all_counts(order) -> Window:
    # The only window without keys: it runs on the histogram.
    return Window.partitionBy(F.lit(1)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def route_pareto(od: DataFrame, percents: Sequence[int] = (50, 80, 90, 95)) -> DataFrame:
    """(pct, n_routes, pct_of_routes): busiest routes needed to exceed a share
    of the trips, i.e. one more than stay within it."""
    run = _all_counts(F.desc("count"))
    trips = F.col("count") * F.col("routes")
    hist = (
        count_histogram(od)
        .withColumns({"trips_upto": F.sum(trips).over(run)})
        .withColumn("before", F.col("trips_upto") - trips)
    )
    totals = F.struct(F.sum(trips).alias("trips"), F.sum("routes").alias("routes"))
    total = count_histogram(od).agg(totals).scalar()
    # Of the routes with one count, those still within the share: whole numbers throughout.
    room = F.col("pct") * F.col("total")["trips"] - F.col("before") * 100
    within = F.least(F.greatest(F.expr("(pct * total.trips - before * 100) div (count * 100)"), F.lit(0)), F.col("routes"))
    return (
        hist.withColumn("total", total)
        .withColumn("pct", F.explode(F.array(*[F.lit(int(p)).cast("long") for p in percents])))
        .withColumn("within", F.when(room < 0, F.lit(0)).otherwise(within))
        .groupBy("pct", F.col("total")["routes"].alias("routes"))
        .agg((F.sum("within") + 1).alias("n_routes"))
        .select("pct", "n_routes", (F.col("n_routes") * F.lit(100.0) / F.col("routes")).alias("pct_of_routes"))
    )


def route_cumulative_share(od: DataFrame) -> DataFrame:
    """(count, routes, cum_routes, cum_trips, cum_pct) by descending count; the
    cumulative columns include all routes of that count."""
    run = _all_counts(F.desc("count"))
    trips = F.col("count") * F.col("routes")
    total = od.agg(F.sum("count")).scalar()
    return count_histogram(od).select(
        "count",
        "routes",
        F.sum("routes").over(run).alias("cum_routes"),
        F.sum(trips).over(run).alias("cum_trips"),
        (F.sum(trips).over(run) / total).alias("cum_pct"),
    )


def route_cdf(od: DataFrame) -> DataFrame:
    """(count, cdf): share of routes with at most that many trips."""
    total = od.agg(F.count(F.lit(1))).scalar()
    return count_histogram(od).select(
        "count", (F.sum("routes").over(_all_counts(F.asc("count"))) / total).alias("cdf")
    )


def route_diversity(od: DataFrame) -> DataFrame:
    """(direction, mean, max) of distinct destinations per origin and of
    distinct origins per destination."""
    ends = F.array(
        F.struct(F.lit("outgoing").alias("direction"), F.col("start_station_name").alias("station_name")),
        F.struct(F.lit("incoming").alias("direction"), F.col("end_station_name").alias("station_name")),
    )
    return (
        od.select(F.inline(ends))
        .groupBy("direction", "station_name")
        .agg(F.count(F.lit(1)).alias("routes"))
        .groupBy("direction")
        .agg(F.avg("routes").alias("mean"), F.max("routes").alias("max"))
    )


def sparsity(trips: DataFrame) -> DataFrame:
    """Stations, possible and observed pairs, sparsity."""
    routes = od_counts(trips).agg(F.count(F.lit(1))).scalar()
    n = F.col("n_stations")
    return (
        station_names(trips)
        .agg(F.count(F.lit(1)).alias("n_stations"))
        .select(
            "n_stations",
            (n * n).alias("n_possible"),
            routes.alias("n_observed"),
            (F.lit(1.0) - F.try_divide(routes, n * n)).alias("sparsity"),
        )
    )


def transition_probabilities(od: DataFrame) -> DataFrame:
    """Share of each route among its origin's trips."""
    return od.withColumn("prob", F.col("count") / F.sum("count").over(Window.partitionBy("start_station_name")))


def top_station_probabilities(trips: DataFrame, n: int = 30) -> DataFrame:
    """Transition probabilities among the ``n`` busiest stations, normalised
    within them; pairs without trips are 0."""
    top = station_activity(trips).orderBy(F.desc("total_trips"), "station_name").limit(n).select("station_name")
    kept = transition_probabilities(between_known(od_counts(trips), top))
    # The dense matrix covers the names that occur at each end: at most n*n cells.
    starts = kept.select("start_station_name").distinct()
    ends = kept.agg(F.array_sort(F.collect_set("end_station_name"))).scalar()
    cells = starts.select("start_station_name", F.explode(ends).alias("end_station_name"))
    return cells.join(kept, ["start_station_name", "end_station_name"], "left").select(
        "start_station_name",
        "end_station_name",
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
        F.coalesce("prob", F.lit(0.0)).alias("prob"),
    )
