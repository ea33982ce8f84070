"""Rolling-window folds and their calendar.

Every table here is bounded by the calendar (folds x days), never by the number
of trips, which is what makes broadcasting it safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.time import add_seconds, day_start, is_weekend
from dockflow.params import BURN_IN_DAYS, HOUR, TEST_WEEKS, TRAIN_WEEKS

FOLD_COLUMNS = ["fold_id", "train_start", "train_end", "test_start", "test_end"]


def rolling_folds(
    starts: DataFrame,
    train_weeks: int = TRAIN_WEEKS,
    test_weeks: int = TEST_WEEKS,
    increment_days: int | None = None,
    ts: str = "started_at",
) -> DataFrame:
    """Folds from the first midnight on, as long as the test window ends by the
    midnight of the last day. The default increment is the test window."""
    step = increment_days if increment_days is not None else 7 * test_weeks
    train_days, test_days = 7 * train_weeks, 7 * test_weeks
    span = starts.agg(F.to_date(F.min(ts)).alias("first"), F.to_date(F.max(ts)).alias("last"))
    room = F.date_diff("last", "first") - F.lit(train_days + test_days)
    day = lambda shift: day_start(F.date_add(F.col("first"), F.col("fold_id") * step + shift))
    return (
        span.withColumn("room", room)
        .where(F.col("room") >= 0)
        .withColumn("fold_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("room") / F.lit(step)).cast("int"))))
        .select(
            "fold_id",
            day(0).alias("train_start"),
            day(train_days).alias("train_end"),
            day(train_days).alias("test_start"),
            day(train_days + test_days).alias("test_end"),
        )
    )


def _days(start: Column, end: Column, role: str) -> Column:
    last = F.to_date(add_seconds(end, -1))
    return F.transform(F.sequence(F.to_date(start), last), lambda d: F.struct(F.lit(role).alias("role"), d.alias("day")))


def fold_days(folds: DataFrame, *roles: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(fold_id, role, day, *keep) for roles train, test and burn_in. Buckets
    join it on their date, an equality instead of a range condition."""
    test_start = F.col("test_start")
    spans = {
        "train": lambda: _days(F.col("train_start"), F.col("train_end"), "train"),
        "test": lambda: _days(test_start, F.col("test_end"), "test"),
        "burn_in": lambda: _days(add_seconds(test_start, -86400 * BURN_IN_DAYS), test_start, "burn_in"),
    }
    chosen = [spans[r]() for r in (roles or tuple(spans))]
    return folds.select("fold_id", *keep, F.inline(F.concat(*chosen)))


def on_fold_days(buckets: DataFrame, days: DataFrame) -> DataFrame:
    """Attach fold_id (and role) to each bucketed row that falls in a fold day."""
    return buckets.withColumn("day", F.to_date("bucket")).join(F.broadcast(days), "day").drop("day")


def fold_facts(folds: DataFrame, buckets: DataFrame) -> DataFrame:
    """Folds that have training and test trips, with the calendar counts the
    fits divide by.

    ``buckets``: any table with the hourly ``bucket`` of the trips. Only its
    distinct hours matter.
    """
    hours = buckets.select("bucket").distinct()
    on_days = on_fold_days(hours, fold_days(folds))
    weekend = is_weekend("bucket")
    train, date = F.col("role") == "train", F.to_date("bucket")
    counts = on_days.groupBy("fold_id").agg(
        F.count_if(train).alias("train_hours"),
        F.count_distinct(F.when(train & ~weekend, date)).alias("train_weekdays"),
        F.count_distinct(F.when(train & weekend, date)).alias("train_weekend_days"),
        F.count_if(F.col("role") == "test").alias("test_hours"),
        (F.count_if(F.col("role") == "burn_in") > 0).alias("has_burn_in"),
    )
    return folds.join(F.broadcast(counts), "fold_id").where((F.col("train_hours") > 0) & (F.col("test_hours") > 0))


def context_days(folds: DataFrame, buckets: DataFrame) -> DataFrame:
    """(fold_id, hour, is_weekend, n_days): training dates with a trip in the context."""
    hours = buckets.select("bucket").distinct()
    return (
        on_fold_days(hours, fold_days(folds, "train"))
        .groupBy("fold_id", F.hour("bucket").alias("hour"), is_weekend("bucket").alias("is_weekend"))
        .agg(F.count_distinct(F.to_date("bucket")).alias("n_days"))
    )


def fold_counts(daily: DataFrame, folds: DataFrame, keys: list[str], together: list[str]) -> DataFrame:
    """(fold_id, *keys, trips): training trips of each key in each fold that has any.

    ``daily``: (*keys, day, trips), any number of rows a day. Folds of one
    training length are a lane, numbered by their start, so a day lies in
    consecutive ones: its trips enter at the first and leave after the last, two
    events however many folds overlap, and counts are running totals of the
    events. Rows are shuffled once, by ``together``, a part of the keys, before
    there are events; the result still lies by it.
    """
    lane = F.date_diff(add_seconds("train_end", -1), "train_start")
    at = Window.partitionBy("lane").orderBy("train_start", "fold_id")
    lanes = folds.select("fold_id", "train_start", "train_end", lane.alias("lane")).withColumn("idx", F.row_number().over(at) - 1)
    inside = fold_days(lanes, "train", keep=("lane", "idx")).groupBy("day", "lane")
    spans = inside.agg(F.min("idx").alias("enters"), (F.max("idx") + 1).alias("leaves"))
    both = F.array(F.struct(F.col("enters").alias("idx"), "trips"), F.struct(F.col("leaves").alias("idx"), (-F.col("trips")).alias("trips")))
    # Both broadcast tables are bounded by the calendar: a row for each day and training length, and one for each fold.
    events = daily.repartition(*together).join(F.broadcast(spans), "day").select(*keys, "lane", F.inline(both))
    along = Window.partitionBy(*keys, "lane").orderBy("idx")
    changes = events.groupBy(*keys, "lane", "idx").agg(F.sum("trips").alias("change"))
    levels = changes.select(*keys, "lane", "idx", F.lead("idx").over(along).alias("next"), F.sum("change").over(along).alias("trips"))
    each = levels.where("trips > 0").withColumn("idx", F.explode(F.sequence("idx", F.col("next") - 1)))
    return each.join(F.broadcast(lanes.select("fold_id", "lane", "idx")), ["lane", "idx"]).select("fold_id", *keys, "trips")


def fold_array(folds: DataFrame, *columns: str) -> Column:
    """The fold table as one array literal, for exploding onto a station row
    without a join."""
    return folds.agg(F.sort_array(F.collect_list(F.struct("fold_id", *columns)))).scalar()


def stations_by_fold(station_stats: DataFrame, folds: DataFrame, *columns: str) -> DataFrame:
    """One row per station and fold."""
    return station_stats.select("station_name", "capacity", F.inline(fold_array(folds, *columns)))


def time_grid(start: Column, end: Column, seconds: int = HOUR) -> Column:
    """Array of the timestamps of [start, end) at a fixed step."""
    steps = grid_size(start, end, seconds)
    return F.transform(F.sequence(F.lit(0), steps - 1), lambda i: add_seconds(start, i * seconds))


def grid_size(start: Column, end: Column, seconds: int = HOUR) -> Column:
    return F.ceil(F.timestamp_diff("SECOND", start, end) / F.lit(float(seconds))).cast("int")


def fold_trip_counts(starts: DataFrame, folds: DataFrame) -> DataFrame:
    """Training, test and burn-in trips per fold. ``starts``: (bucket, trips)."""
    per_day = starts.groupBy(F.to_date("bucket").alias("day")).agg(F.sum("trips").alias("trips"))
    in_fold = per_day.join(F.broadcast(fold_days(folds)), "day")
    count = lambda role: F.coalesce(F.sum(F.when(F.col("role") == role, F.col("trips"))), F.lit(0))
    return (
        folds.join(in_fold, "fold_id", "left")
        .groupBy(*FOLD_COLUMNS)
        .agg(
            count("train").alias("train_trips"),
            count("test").alias("test_trips"),
            count("burn_in").alias("burn_in_trips"),
        )
    )
