"""Training-window sweep: several fold configurations validated together."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.operators.compare import normalized_configs, recommend_configs
from dockflow.operators.evaluate import summarize_folds
from dockflow.plans.cross_validation import Prepared, cross_validate, folds_of
from dockflow.session import union_all

# Fixed configurations of the sweep: (train weeks, test weeks, increment days).
CONFIGURATIONS = [(1, 1, 7), (2, 1, 7), (3, 1, 7)]
# The same, with test windows of two weeks beside those of one.
TEST_LENGTHS = [(1, 1, 7), (2, 1, 7), (1, 2, 7), (2, 2, 7)]
_FOLDS_PER_CONFIG = 1_000_000


def configurations(spark: SparkSession, configs: list[tuple[int, int, int]] | None = None) -> DataFrame:
    rows = [(i, t, w, d, f"{t}w train, {w}w test") for i, (t, w, d) in enumerate(configs or CONFIGURATIONS, 1)]
    return spark.createDataFrame(rows, "config_id int, train_weeks int, test_weeks int, increment_days int, label string")


def sweep_folds(data: Prepared, configs: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The folds of all configurations, numbered so that they stay apart."""
    parts = [
        folds_of(data, train, test, step).withColumn("fold_id", F.col("fold_id") + i * _FOLDS_PER_CONFIG)
        for i, (train, test, step) in enumerate(configs or CONFIGURATIONS, 1)
    ]
    return union_all(*parts)


def lookback_sweep(
    data: Prepared, configs: list[tuple[int, int, int]] | None = None, model: str = "markov", **options: Any
) -> DataFrame:
    """Fold metrics with config_id and the fold's number within it. Windows of
    different test length need separate grids, so they are validated per length."""
    chosen = list(enumerate(configs or CONFIGURATIONS, 1))
    folds = sweep_folds(data, configs)
    results = []
    for weeks in sorted({c[1] for _, c in chosen}):
        ids = [i for i, c in chosen if c[1] == weeks]
        part = folds.where((F.col("fold_id") / F.lit(_FOLDS_PER_CONFIG)).cast("int").isin(ids))
        results.append(cross_validate(data, [model], part, weeks, **options))
    return union_all(*results).withColumns(
        {
            "config_id": (F.col("fold_id") / F.lit(_FOLDS_PER_CONFIG)).cast("int"),
            "fold_id": F.col("fold_id") % _FOLDS_PER_CONFIG,
        }
    )


def sweep_summary(metrics: DataFrame) -> DataFrame:
    return summarize_folds(metrics, "config_id")


def sweep_scores(metrics: DataFrame) -> DataFrame:
    return normalized_configs(sweep_summary(metrics))


def sweep_recommendation(metrics: DataFrame, configs: DataFrame) -> DataFrame:
    return recommend_configs(sweep_summary(metrics), configs)
