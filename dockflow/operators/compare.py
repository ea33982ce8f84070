"""Comparison of summaries and fold series of two models or several configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The compared metrics and whether lower or higher is better.
KEY_METRICS = {
    "inventory_mae": "lower",
    "inventory_rmse": "lower",
    "correlation": "higher",
    "empty_recall": "higher",
    "empty_precision": "higher",
    "full_recall": "higher",
    "full_precision": "higher",
    "state_accuracy": "higher",
}
ALL_METRICS = {
    "inventory_mae": "lower",
    "inventory_rmse": "lower",
    "correlation": "higher",
    "empty_recall": "higher",
    "empty_precision": "higher",
    "empty_f1": "higher",
    "full_recall": "higher",
    "full_precision": "higher",
    "full_f1": "higher",
    "state_accuracy": "higher",
}
SWEEP_METRICS = ["inventory_mae", "inventory_rmse", "empty_recall", "full_recall", "state_accuracy"]


def _is_error(metric: Column) -> Column:
    return metric.contains("mae") | metric.contains("rmse")


def _paired(summary: DataFrame, first: str, second: str, metrics: dict[str, str]) -> DataFrame:
    side = lambda m: F.max(F.when(F.col("model") == m, F.col("mean")))
    spread = lambda m: F.max(F.when(F.col("model") == m, F.col("std")))
    lower = [m for m, better in metrics.items() if better == "lower"]
    return (
        summary.where(F.col("model").isin(first, second) & F.col("metric").isin(*metrics))
        .groupBy("metric")
        .agg(
            side(first).alias("first_mean"),
            spread(first).alias("first_std"),
            side(second).alias("second_mean"),
            spread(second).alias("second_std"),
        )
        .where(F.col("first_mean").isNotNull() & F.col("second_mean").isNotNull())
        .withColumn("lower_is_better", F.col("metric").isin(*lower))
    )


def compare_models(summary: DataFrame, current: str, other: str) -> DataFrame:
    """Per key metric: both means, delta and whether ``current`` is better."""
    delta = F.col("first_mean") - F.col("second_mean")
    return _paired(summary, current, other, KEY_METRICS).select(
        "metric",
        F.col("second_mean").alias("other_mean"),
        F.col("first_mean").alias("current_mean"),
        delta.alias("delta"),
        F.when(F.col("lower_is_better"), delta < 0).otherwise(delta > 0).alias("is_better"),
    )


def improvements(comparison: DataFrame) -> DataFrame:
    return comparison.agg(F.count_if("is_better").alias("improved"), F.count(F.lit(1)).alias("compared"))


def compare_models_pct(summary: DataFrame, first: str, second: str) -> DataFrame:
    """Per metric: difference of ``second`` to ``first``, absolute and percent,
    and the winner; ties go to ``second``."""
    a, b = F.col("first_mean"), F.col("second_mean")
    first_wins = F.when(F.col("lower_is_better"), a < b).otherwise(a > b)
    return _paired(summary, first, second, ALL_METRICS).select(
        "metric",
        "first_mean",
        "first_std",
        "second_mean",
        "second_std",
        (b - a).alias("diff"),
        F.coalesce(F.try_divide(b - a, a) * 100, F.lit(0.0)).alias("pct_diff"),
        F.when(first_wins, F.lit(first)).otherwise(F.lit(second)).alias("winner"),
    )


def wins(comparison: DataFrame, first: str, second: str) -> DataFrame:
    a, b = F.count_if(F.col("winner") == first), F.count_if(F.col("winner") == second)
    overall = F.when(a > b, F.lit(first)).when(b > a, F.lit(second)).otherwise(F.lit("Tie"))
    return comparison.agg(a.alias("first_wins"), b.alias("second_wins"), overall.alias("overall_winner"))


def advantage(summary: DataFrame, first: str, second: str) -> DataFrame:
    """Positive where ``first`` is better; errors count the other way round."""
    a, b = F.col("first_mean"), F.col("second_mean")
    return _paired(summary, first, second, ALL_METRICS).select(
        "metric", F.when(_is_error(F.col("metric")), b - a).otherwise(a - b).alias("advantage")
    )


def fold_series(metrics: DataFrame, first: str, second: str, metric: str = "inventory_mae", skip: int = 0) -> DataFrame:
    """A metric of both models fold by fold, their difference and its mean.

    ``skip`` drops that many leading folds, as fold reports do.
    """
    value = lambda m: F.max(F.when(F.col("model") == m, F.col(metric)))
    paired = (
        metrics.where(F.col("model").isin(first, second) & (F.col("fold_id") >= skip))
        .groupBy("fold_id")
        .agg(value(first).alias("first_value"), value(second).alias("second_value"))
        .withColumn("diff", F.col("second_value") - F.col("first_value"))
    )
    winner = F.when(F.col("first_value") < F.col("second_value"), F.lit(first)).otherwise(F.lit(second))
    # One row per fold: the calendar bounds this window.
    return paired.select(
        "fold_id",
        "first_value",
        "second_value",
        "diff",
        winner.alias("winner"),
        F.avg("diff").over(Window.partitionBy(F.lit(1))).alias("mean_diff"),
    )


def normalized_configs(summary: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Min-max scores of each metric over the configurations, errors inverted;
    a constant metric scores 0.5 with deviation 0."""
    over = Window.partitionBy("metric")
    low, high = F.min("mean").over(over), F.max("mean").over(over)
    scaled = (
        summary.where(F.col("metric").isin(*(metrics or SWEEP_METRICS)))
        .withColumns({"low": low, "high": high})
        .withColumn("range", F.col("high") - F.col("low"))
    )
    gap = F.when(_is_error(F.col("metric")), F.col("high") - F.col("mean")).otherwise(F.col("mean") - F.col("low"))
    return scaled.select(
        "config_id",
        "metric",
        F.coalesce(F.try_divide(gap, F.col("range")), F.lit(0.5)).alias("score"),
        F.coalesce(F.try_divide(F.col("std"), F.col("range")), F.lit(0.0)).alias("score_std"),
    )


def recommend_configs(summary: DataFrame, configs: DataFrame) -> DataFrame:
    """Best configuration by lowest MAE and by highest empty recall, full recall
    and state accuracy, with the mean MAE of short (up to 2 weeks) and long (3 or
    more) training windows and of one- and two-week test windows. Equal means go
    to the smaller config_id."""
    wide = (
        summary.where(F.col("metric").isin(*SWEEP_METRICS))
        .groupBy("config_id")
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("mean"))).alias(m) for m in SWEEP_METRICS])
        .join(configs.select("config_id", "train_weeks", "test_weeks"), "config_id")
    )
    cid = F.col("config_id")
    lowest = F.min(F.struct(F.col("inventory_mae").alias("v"), cid))["config_id"]
    highest = lambda m: F.min(F.struct((-F.col(m)).alias("v"), cid))["config_id"]
    mae_if = lambda cond: F.avg(F.when(cond, F.col("inventory_mae")))
    return wide.agg(
        lowest.alias("lowest_mae_config"),
        highest("empty_recall").alias("best_empty_config"),
        highest("full_recall").alias("best_full_config"),
        highest("state_accuracy").alias("best_state_config"),
        mae_if(F.col("train_weeks") <= 2).alias("short_train_mae"),
        mae_if(F.col("train_weeks") >= 3).alias("long_train_mae"),
        mae_if(F.col("test_weeks") == 1).alias("one_week_test_mae"),
        mae_if(F.col("test_weeks") == 2).alias("two_week_test_mae"),
    )
