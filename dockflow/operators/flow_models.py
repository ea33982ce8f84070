"""Persistence, station-average and temporal-flow forecasts, all folds at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.numeric import station_state
from dockflow.functions.paths import CONTEXTS, clamped_context_walk, clamped_walk
from dockflow.functions.time import is_weekend
from dockflow.operators.folds import fold_days, grid_size, on_fold_days
from dockflow.params import DEFAULT_CAPACITY, HOUR
from dockflow.session import cut


def fit_station_avg(flows: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold_id, station_name, avg_flow): net flow over the number of distinct
    hours with a training trip; ``folds`` carries ``train_hours``."""
    days = fold_days(folds, "train", keep=("train_hours",))
    return (
        on_fold_days(flows, days)
        .groupBy("fold_id", "train_hours", "station_name")
        .agg(F.sum("net").alias("net"))
        .select("fold_id", "station_name", (F.col("net") / F.greatest("train_hours", F.lit(1))).alias("avg_flow"))
    )


def fit_temporal_flow(flows: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold_id, station_name, hour, is_weekend, avg_flow): net flow over the
    training dates of that day type; observed keys only."""
    days = fold_days(folds, "train", keep=("train_weekdays", "train_weekend_days"))
    weekend = is_weekend("bucket")
    dates = F.when(weekend, F.col("train_weekend_days")).otherwise(F.col("train_weekdays"))
    return (
        on_fold_days(flows, days)
        .groupBy("fold_id", "station_name", F.hour("bucket").alias("hour"), weekend.alias("is_weekend"), dates.alias("dates"))
        .agg(F.sum("net").alias("net"))
        .select(
            "fold_id",
            "station_name",
            "hour",
            "is_weekend",
            (F.col("net") / F.greatest("dates", F.lit(1))).alias("avg_flow"),
        )
    )


def mean_flow(params: DataFrame) -> DataFrame:
    """(fold_id, global_flow): the mean over a fold's fitted keys, which keys
    never seen in training move with.

    Rows may hold several keys each, with their ``total`` and number ``keys``.
    Totals are added as decimals: net flows cancel, and what the order of addition
    would leave instead of 0 moves a station that stands at a threshold across it.
    """
    if "keys" not in params.columns:
        return params.groupBy("fold_id").agg(F.avg("avg_flow").alias("global_flow"))
    exact = F.col("total").try_cast("decimal(38,18)")
    total = F.when(F.count(exact) == F.count("total"), F.sum(exact).cast("double")).otherwise(F.sum("total"))
    return params.groupBy("fold_id").agg((total / F.sum("keys")).alias("global_flow"))


def _capacity() -> Column:
    return F.coalesce("capacity", F.lit(DEFAULT_CAPACITY))


def _trajectory(joined: DataFrame, bikes: Column) -> DataFrame:
    return joined.select(
        "fold_id", "station_name", "capacity", F.col("test_start").alias("start_ts"), bikes.alias("bikes")
    )


def forecast_persistence(init: DataFrame, seconds: int = HOUR) -> DataFrame:
    """Every step repeats the initial inventory."""
    steps = grid_size(F.col("test_start"), F.col("test_end"), seconds)
    return _trajectory(init, F.array_repeat(F.col("bikes").cast("double"), steps))


def forecast_station_avg(params: DataFrame, init: DataFrame, seconds: int = HOUR) -> DataFrame:
    """The station's average flow at every step; unseen stations move with the
    mean of all stations."""
    joined = init.join(params, ["fold_id", "station_name"], "left").join(F.broadcast(mean_flow(params)), "fold_id")
    flow = F.coalesce("avg_flow", "global_flow")
    steps = grid_size(F.col("test_start"), F.col("test_end"), seconds)
    return _trajectory(joined, clamped_walk(F.col("bikes"), _capacity(), steps, flow))


def forecast_temporal_flow(params: DataFrame, init: DataFrame, seconds: int = HOUR) -> DataFrame:
    """The flow of the target step's (hour, weekend) context; a key never seen
    in training moves with the mean of all keys, not with 0.

    The keys are gathered once, a row per fold and station, and kept: both the
    walk and the mean read them.
    """
    context = F.col("hour") * 2 + F.col("is_weekend").cast("int")
    # A key's row has one flow for each of the contexts: aggregates of a fixed size, so nothing is sorted.
    flow_of = [F.max(F.when(F.col("context") == c, F.col("avg_flow"))) for c in range(CONTEXTS)]
    keyed = cut(
        params.withColumn("context", context)
        .groupBy("fold_id", "station_name")
        .agg(F.array(*flow_of).alias("seen"), F.count("avg_flow").alias("keys"))
    )
    total = F.aggregate("seen", F.lit(0.0), lambda x, flow: x + F.coalesce(flow, F.lit(0.0)))
    mean = mean_flow(keyed.select("fold_id", "keys", total.alias("total")))
    joined = init.join(keyed, ["fold_id", "station_name"], "left").join(F.broadcast(mean), "fold_id")
    steps = grid_size(F.col("test_start"), F.col("test_end"), seconds)
    walked = clamped_context_walk(
        F.col("bikes"), _capacity(), steps, F.col("seen"), F.col("global_flow"), F.col("test_start"), seconds
    )
    return _trajectory(joined, walked)


def forecast_states(long_forecast: DataFrame, empty: float, full: float) -> DataFrame:
    """A forecast in long form with its empty / normal / full state."""
    return long_forecast.withColumn("state", station_state("bikes", "capacity", empty, full))


def station_avg_report(params: DataFrame) -> DataFrame:
    return params.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n_stations"), F.avg("avg_flow").alias("global_avg_flow")
    )


def temporal_flow_report(params: DataFrame) -> DataFrame:
    return params.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n_flow_combinations"), F.avg("avg_flow").alias("global_avg_flow")
    )
