"""Rolling-window cross-validation of all folds and models in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators import ensemble, evaluate, flow_models, markov
from dockflow.operators.endpoints import flow_from_od, od_by_hour
from dockflow.operators.folds import fold_facts, rolling_folds
from dockflow.operators.inventory import initial_inventory, track_inventory
from dockflow.operators.prepare import prepare_od, trips_of_stations
from dockflow.params import (
    EMPTY_THRESHOLD,
    FULL_THRESHOLD,
    HOUR,
    MIN_TRIPS,
    TEST_WEEKS,
    TRAIN_WEEKS,
)
from dockflow.session import cut, resident, setting, union_all

#: Bytes of files that a task takes of the trips: few enough that the hours and pairs it
#: finds, often as many as its trips, are counted in memory.
SCAN_BYTES = "16m"
MODELS = ("persistence", "station_avg", "temporal_flow", "baseline", "markov")


class Prepared(NamedTuple):
    """od: hourly trips between valid stations; flows: their hourly station
    flows; stations: (station_name, capacity); hours: the distinct buckets of
    ``flows``, if they are at hand."""

    od: DataFrame
    flows: DataFrame
    stations: DataFrame
    hours: DataFrame | None = None

    def buckets(self) -> DataFrame:
        """A table with the buckets of the trips, the smallest there is."""
        return self.flows if self.hours is None else self.hours


class Folded(NamedTuple):
    """folds with their calendar facts; init: inventory at each test start;
    truth: observed trajectories."""

    folds: DataFrame
    init: DataFrame
    truth: DataFrame


def model_name(name: str) -> str:
    """The canonical name of a model; unknown names are an error."""
    if name not in MODELS:
        raise ValueError(f"unknown model: {name}; available: {list(MODELS)}")
    return "temporal_flow" if name == "baseline" else name


def prepared(trips: DataFrame, stations: DataFrame, min_trips: int = MIN_TRIPS) -> Prepared:
    """One scan of the trips. Everything after it works on the hourly
    origin-destination table, kept once because folds read it many times.

    Flows lie by station: what is grouped by fold and station is grouped where it lies.
    """
    with setting(trips.sparkSession, "spark.sql.files.maxPartitionBytes", SCAN_BYTES):
        od = od_by_hour(trips).persist()
        counts = trips_of_stations(od).persist()
        # Reads the trips, while the setting holds; later plans find the counts kept.
        busiest = counts.agg(F.max(F.col("departures") + F.col("arrivals"))).first()[0] or 0
    kept, stats = prepare_od(od, stations, min_trips)
    stats = stats.persist()
    hours = od.agg(F.timestamp_diff("HOUR", F.min("bucket"), F.max("bucket"))).first()[0] or 0
    # Summing before the shuffle leaves a station a row per hour and task. Where none has
    # more trips than there are hours, its trips are no more rows than that.
    if busiest <= hours:
        flows = flow_from_od(kept, by_station=True).persist()
    else:
        flows = flow_from_od(kept).repartition("station_name").persist()
    return Prepared(kept, flows, stats, flows.select("bucket").distinct().persist())


def folded(data: Prepared, folds: DataFrame) -> Folded:
    """Facts, initial inventories and observed trajectories of the folds."""
    facts = facts_of(data, folds)
    init = cut(initial_inventory(data.flows, data.stations, facts))
    return Folded(facts, init, track_inventory(data.flows, init, windows=facts))


def folds_of(
    data: Prepared, train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS, increment_days: int | None = None
) -> DataFrame:
    return resident(rolling_folds(data.buckets(), train_weeks, test_weeks, increment_days, ts="bucket"))


def facts_of(data: Prepared, folds: DataFrame) -> DataFrame:
    return resident(fold_facts(folds, data.buckets()))


def forecast(
    model: str,
    data: Prepared,
    fold: Folded,
    steps: int,
    min_transitions: int = 1,
    n_simulations: int = 1,
    seed: int = 42,
) -> DataFrame:
    """Trajectories of one model for every fold."""
    name = model_name(model)
    if name == "persistence":
        return flow_models.forecast_persistence(fold.init)
    if name == "station_avg":
        return flow_models.forecast_station_avg(cut(flow_models.fit_station_avg(data.flows, fold.folds)), fold.init)
    if name == "temporal_flow":
        return flow_models.forecast_temporal_flow(flow_models.fit_temporal_flow(data.flows, fold.folds), fold.init)
    fit = markov.fit_markov(data.od, fold.folds, min_transitions)
    if n_simulations == 1:
        return markov.forecast_markov(fit, fold.init, steps)
    return ensemble.forecast_ensemble(fit, fold.init, steps, n_simulations, seed)


def cross_validate(
    data: Prepared,
    models: Sequence[str],
    folds: DataFrame,
    test_weeks: int = TEST_WEEKS,
    empty: float = EMPTY_THRESHOLD,
    full: float = FULL_THRESHOLD,
    **options: Any,
) -> DataFrame:
    """One metric row per model and fold. Folds without training or test trips
    are left out. ``folds`` may come from several configurations, as long as
    their test windows are ``test_weeks`` long."""
    fold = folded(data, folds)
    steps = test_weeks * 7 * 86400 // HOUR
    paths = [
        forecast(model, data, fold, steps, **options).withColumn("model", F.lit(model_name(model))) for model in models
    ]
    if not paths:
        raise ValueError("no models")
    pairs = evaluate.align_paths(fold.truth, union_all(*paths), "model", whole=True)
    metrics = evaluate.fold_metrics(pairs, "model", empty=empty, full=full)
    dates = fold.folds.select("fold_id", F.to_date("train_start").alias("train_start"), F.to_date("test_start").alias("test_start"))
    return metrics.join(F.broadcast(dates), "fold_id")


def run_cross_validation(
    trips: DataFrame,
    stations: DataFrame,
    models: Sequence[str] = ("temporal_flow",),
    train_weeks: int = TRAIN_WEEKS,
    test_weeks: int = TEST_WEEKS,
    increment_days: int | None = None,
    min_trips: int = MIN_TRIPS,
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics, summary of mean and deviation per metric) from raw trips."""
    data = prepared(trips, stations, min_trips)
    folds = folds_of(data, train_weeks, test_weeks, increment_days)
    metrics = cross_validate(data, models, folds, test_weeks, **options)
    return metrics, evaluate.summarize_folds(metrics, "model")


def fit_everything(data: Prepared) -> DataFrame:
    """A single fold that trains on all trips, for fitting without validation."""
    span = data.flows.agg(F.to_date(F.min("bucket")).alias("first"), F.to_date(F.max("bucket")).alias("last"))
    midnight = lambda c: c.cast("timestamp_ntz")
    day_after = midnight(F.date_add("last", 1))
    whole = span.select(
        F.lit(0).alias("fold_id"),
        midnight(F.col("first")).alias("train_start"),
        day_after.alias("train_end"),
        # The facts ask for test trips too; all of them are both.
        midnight(F.col("first")).alias("test_start"),
        day_after.alias("test_end"),
    )
    return fold_facts(whole, data.flows)
