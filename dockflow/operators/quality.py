"""Data checks and whole-network figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.time import duration_minutes
from dockflow.operators.prepare import drop_unnamed
from dockflow.operators.quantiles import exact_quantiles
from dockflow.operators.routes import route_diversity, self_loops
from dockflow.session import cut, union_all


def null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls, pct) of the columns with nulls, and rows with any null
    under the name ``any``; one scan."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
        F.count_if(any_null).alias("any"),
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in [*columns, "any"]])
    return counts.select("_rows", F.inline(cells)).where(F.col("nulls") > 0).select(
        "column", "nulls", F.round(F.col("nulls") * F.lit(100.0) / F.col("_rows"), 2).alias("pct")
    )


def duration_anomalies(trips: DataFrame) -> DataFrame:
    """Trips with negative, zero, over one hour and over one day durations, and
    those in the plausible band (0, 60]."""
    d = F.col("d")
    return trips.select(duration_minutes().alias("d")).agg(
        F.count_if(d < 0).alias("negative"),
        F.count_if(d == 0).alias("zero"),
        F.count_if(d > 60).alias("over_hour"),
        F.count_if(d > 1440).alias("over_day"),
        F.count_if((d > 0) & (d <= 60)).alias("plausible"),
    )


def plausible_durations(trips: DataFrame) -> DataFrame:
    """Trips of the plausible band with their minutes."""
    d = F.col("duration_min")
    return trips.withColumn("duration_min", duration_minutes()).where((d > 0) & (d <= 60))


def describe_durations(trips: DataFrame) -> DataFrame:
    """(stat, value): describe() of the trip minutes with exact quartiles."""
    d = F.col("d")
    moments = trips.select(duration_minutes().alias("d")).agg(
        F.count(d).cast("double").alias("count"),
        F.avg(d).alias("mean"),
        F.stddev_samp(d).alias("std"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
    )
    names = ("count", "mean", "std", "min", "max")
    cells = F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).alias("value")) for c in names])
    quartiles = exact_quantiles(trips, duration_minutes(), [0.25, 0.5, 0.75]).select(
        F.concat(F.lit("q"), (F.col("prob") * 100).cast("int").cast("string")).alias("stat"),
        F.col("quantile").alias("value"),
    )
    return union_all(moments.select(F.inline(cells)), quartiles)


def median_duration(trips: DataFrame) -> DataFrame:
    return exact_quantiles(trips, duration_minutes(), [0.5]).select(F.col("quantile").alias("median_minutes"))


def network_summary(trips: DataFrame, types: list[str], members: list[str]) -> DataFrame:
    """One row of figures for the whole network: size, period, shares per
    vehicle and rider type, median duration, self loops, diversity, sparsity.

    The trips are read twice: for a table of origin and destination pairs, which
    is written once and answers all but the median, and for the durations.
    """
    shares = [(c, v) for c, vs in (("rideable_type", types), ("member_casual", members)) for v in vs]
    pairs = cut(
        trips.groupBy("start_station_name", "end_station_name").agg(
            F.count(F.lit(1)).alias("count"),
            F.min("started_at").alias("first"),
            F.max("started_at").alias("last"),
            *[F.count_if(F.col(c) == v).alias(f"n_{v}") for c, v in shares],
            *[F.count(c).alias(f"known_{v}") for c, v in shares],
        )
    )
    od = drop_unnamed(pairs).select("start_station_name", "end_station_name", "count")
    missing = sum(F.when(F.col(c).isNull(), F.col("count")).otherwise(0) for c in ("start_station_name", "end_station_name"))
    base = pairs.agg(
        F.sum("count").alias("total_trips"),
        F.to_date(F.min("first")).alias("first_date"),
        F.to_date(F.max("last")).alias("last_date"),
        *[F.try_divide(F.sum(f"n_{v}"), F.sum(f"known_{v}")).alias(f"share_{v}") for _, v in shares],
        F.sum(missing).alias("missing_entries"),
    )
    out = lambda d: route_diversity(od).where(F.col("direction") == d).select("mean").scalar()
    loops = self_loops(od)
    names = pairs.select(F.explode(F.array("start_station_name", "end_station_name")).alias("station_name"))
    n_stations, n_routes = names.agg(F.count_distinct("station_name")).scalar(), od.agg(F.count(F.lit(1))).scalar()
    figures = base.withColumns(
        {
            "total_trips": F.coalesce("total_trips", F.lit(0).cast("long")),
            "missing_entries": F.coalesce("missing_entries", F.lit(0).cast("long")),
            "n_stations": n_stations,
            "n_routes": n_routes,
            "median_minutes": median_duration(trips).scalar(),
            "self_loop_trips": loops.select("self_loop_trips").scalar(),
            "self_loop_pct": loops.select("self_loop_pct").scalar(),
            "mean_destinations": out("outgoing"),
            "mean_origins": out("incoming"),
        }
    )
    n = F.col("n_stations")
    return figures.withColumn("sparsity", F.lit(1.0) - F.try_divide(F.col("n_routes"), n * n))
