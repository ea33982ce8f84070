"""Forecast quality per fold and over folds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from dockflow.functions.numeric import relative_error, safe_ratio, station_state
from dockflow.functions.paths import MOMENTS, MOMENTS_DDL, moments
from dockflow.params import DEFAULT_CAPACITY, EMPTY_THRESHOLD, FULL_THRESHOLD

# Fixed order of the reported metrics.
METRICS = [
    "inventory_mae",
    "inventory_rmse",
    "inventory_mape",
    "n_predictions",
    "n_stations",
    "n_time_periods",
    "correlation",
    "empty_precision",
    "empty_recall",
    "empty_f1",
    "empty_count",
    "empty_predicted_count",
    "full_precision",
    "full_recall",
    "full_f1",
    "full_count",
    "full_predicted_count",
    "state_accuracy",
    "station_mae_mean",
    "station_mae_std",
]


def align(truth: DataFrame, forecast: DataFrame, *keys: str) -> DataFrame:
    """(*keys, fold_id, station_name, capacity, ts, true, pred) of two long
    tables where both have a value."""
    on = ["fold_id", "station_name", "ts"]
    pred = forecast.select(*keys, *on, F.col("bikes").alias("pred"))
    return truth.select(*on, "capacity", F.col("bikes").alias("true")).join(pred, on)


def align_paths(truth: DataFrame, forecasts: DataFrame, *keys: str, whole: bool = False) -> DataFrame:
    """The same from trajectories on one grid: one join row per station instead
    of one per station and step. ``whole`` leaves it at that row, with both paths
    as arrays ``true`` and ``pred``."""
    on = ["fold_id", "station_name"]
    pred = forecasts.select(*keys, *on, F.col("bikes").alias("pred"))
    paired = truth.select(*on, "capacity", "start_ts", F.col("bikes").alias("true")).join(pred, on)
    if whole:
        return paired.select(*keys, *on, "capacity", "true", "pred")
    cells = F.filter(
        F.arrays_zip("true", "pred"), lambda c: c["true"].isNotNull() & c["pred"].isNotNull()
    )
    # A value of each path near its others, about which products can be summed.
    near = [F.get("cells", F.lit(0))[c].alias(f"near_{c}") for c in ("true", "pred")]
    return paired.select(*keys, *on, "capacity", cells.alias("cells")).select(*keys, *on, "capacity", *near, F.inline("cells"))


def _state_counts(state: str) -> list[Column]:
    t, p = F.col("true_state") == state, F.col("pred_state") == state
    return [
        F.count_if(t & p).alias(f"{state}_tp"),
        F.count_if(~t & p).alias(f"{state}_fp"),
        F.count_if(t & ~p).alias(f"{state}_fn"),
    ]


def _state_scores(state: str) -> list[Column]:
    tp, fp, fn = (F.sum(f"{state}_{x}") for x in ("tp", "fp", "fn"))
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    return [
        precision.alias(f"{state}_precision"),
        recall.alias(f"{state}_recall"),
        safe_ratio(2 * precision * recall, precision + recall).alias(f"{state}_f1"),
        (tp + fn).alias(f"{state}_count"),
        (tp + fp).alias(f"{state}_predicted_count"),
    ]


def _cell_moments(pairs: DataFrame, keys: tuple[str, ...], empty: float, full: float) -> DataFrame:
    """Moments and counts per (*keys, fold_id, station_name) of a row per step."""
    true, pred = F.col("true"), F.col("pred")
    stated = pairs.withColumns(
        {
            "true_state": station_state("true", "capacity", empty, full),
            "pred_state": station_state("pred", "capacity", empty, full),
        }
    )
    err = true - pred
    near = {c: F.col(f"near_{c}") if f"near_{c}" in pairs.columns else F.lit(0.0) for c in ("true", "pred")}
    t, p = true - near["true"], pred - near["pred"]
    return stated.groupBy(*keys, "fold_id", "station_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(err)).alias("abs_err"),
        F.sum(err * err).alias("sq_err"),
        F.sum(relative_error(true, pred)).alias("rel_err"),
        F.sum(t).alias("s_t"),
        F.sum(p).alias("s_p"),
        F.sum(t * t).alias("s_tt"),
        F.sum(p * p).alias("s_pp"),
        F.sum(t * p).alias("s_tp"),
        F.first(near["true"]).alias("near_t"),
        F.first(near["pred"]).alias("near_p"),
        *[f(c).alias(f"{name}_{c}") for c in ("true", "pred") for name, f in (("min", F.min), ("max", F.max))],
        *_state_counts("empty"),
        *_state_counts("full"),
        F.count_if(F.col("true_state") == F.col("pred_state")).alias("same_state"),
    )


def _path_moments(pairs: DataFrame, keys: tuple[str, ...], empty: float, full: float) -> DataFrame:
    """The same of a row per station and fold that holds both paths."""
    own = [*keys, "fold_id", "station_name"]
    rows = pairs.select(*own, F.coalesce("capacity", F.lit(DEFAULT_CAPACITY)).alias("capacity"), "true", "pred")

    def run(batches):
        for batch in batches:
            found = moments(batch.column("true"), batch.column("pred"), batch.column("capacity"), empty, full)
            columns = [batch.column(c) for c in own] + [pa.array(found[c]) for c in MOMENTS]
            whole = pa.RecordBatch.from_arrays(columns, names=[*own, *MOMENTS])
            yield whole.filter(pa.array(found["n"] > 0))

    schema = StructType([*pairs.select(*own).schema.fields, *StructType.fromDDL(MOMENTS_DDL).fields])
    return rows.mapInArrow(run, schema)


def fold_metrics(
    pairs: DataFrame, *keys: str, empty: float = EMPTY_THRESHOLD, full: float = FULL_THRESHOLD
) -> DataFrame:
    """One row of all metrics per (*keys, fold_id).

    Two levels: moments and counts per station, then per fold, so a fold's
    cells are never gathered and the per-station errors fall out on the way.
    ``pairs`` has a row per step, or a row per station that holds its whole paths.
    Products are summed about a value near each station's own (``near_true`` and
    ``near_pred`` if rows per step have them, else 0; the first of a whole path), and moved to
    one value per fold when stations are merged, so that large levels don't cost the digits
    of small deviations.
    """
    of_paths = isinstance(pairs.schema["true"].dataType, ArrayType)
    per_station = (_path_moments if of_paths else _cell_moments)(pairs, keys, empty, full)
    # A row per station and fold from here on.
    fold = Window.partitionBy(*keys, "fold_id")
    by = {c: F.col(f"near_{c}") - F.min(f"near_{c}").over(fold) for c in ("t", "p")}
    moved = per_station.withColumns({f"by_{c}": x for c, x in by.items()})
    w, dt, dp, st, sp = (F.col(c) for c in ("n", "by_t", "by_p", "s_t", "s_p"))
    per_station = moved.withColumns(
        {
            "s_tt": F.col("s_tt") + 2 * dt * st + w * dt * dt,
            "s_pp": F.col("s_pp") + 2 * dp * sp + w * dp * dp,
            "s_tp": F.col("s_tp") + dt * sp + dp * st + w * dt * dp,
            "s_t": st + w * dt,
            "s_p": sp + w * dp,
        }
    )
    n = F.sum("n")
    station_mae = F.col("abs_err") / F.col("n")
    s = {c: F.sum(c) for c in ("s_t", "s_p", "s_tt", "s_pp", "s_tp")}
    cov = n * s["s_tp"] - s["s_t"] * s["s_p"]
    spread = F.sqrt(F.greatest(n * s["s_tt"] - s["s_t"] * s["s_t"], F.lit(0.0))) * F.sqrt(
        F.greatest(n * s["s_pp"] - s["s_p"] * s["s_p"], F.lit(0.0))
    )
    constant = (F.min("min_true") == F.max("max_true")) | (F.min("min_pred") == F.max("max_pred"))
    return per_station.groupBy(*keys, "fold_id").agg(
        (F.sum("abs_err") / n).alias("inventory_mae"),
        F.sqrt(F.sum("sq_err") / n).alias("inventory_rmse"),
        (F.sum("rel_err") / n).alias("inventory_mape"),
        n.alias("n_predictions"),
        F.count(F.lit(1)).alias("n_stations"),
        F.max("n").alias("n_time_periods"),
        F.when(constant, F.lit(0.0)).otherwise(safe_ratio(cov, spread)).alias("correlation"),
        *_state_scores("empty"),
        *_state_scores("full"),
        safe_ratio(F.sum("same_state"), n).alias("state_accuracy"),
        F.avg(station_mae).alias("station_mae_mean"),
        F.stddev_pop(station_mae).alias("station_mae_std"),
    )


def confusion(pairs: DataFrame, *keys: str, empty: float = EMPTY_THRESHOLD, full: float = FULL_THRESHOLD) -> DataFrame:
    """Cells per (true state, predicted state)."""
    return pairs.groupBy(
        *keys,
        "fold_id",
        station_state("true", "capacity", empty, full).alias("true_state"),
        station_state("pred", "capacity", empty, full).alias("pred_state"),
    ).agg(F.count(F.lit(1)).alias("cells"))


def long_metrics(metrics: DataFrame, *keys: str) -> DataFrame:
    """(*keys, metric, value)."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS])
    return metrics.select(*keys, F.inline(cells))


def summarize_folds(metrics: DataFrame, *keys: str) -> DataFrame:
    """(*keys, metric, mean, std): population deviation over the folds."""
    return (
        long_metrics(metrics, *keys)
        .groupBy(*keys, "metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )


