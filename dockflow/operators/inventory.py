"""Inventories as clamped running totals of net flow.

A trajectory is one row per (fold, station) whose ``bikes`` array holds one
value per time step. The horizon bounds the array, and joining trajectories
costs one row per station instead of one per station and hour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.numeric import clamp
from dockflow.functions.paths import tracked_total
from dockflow.functions.time import add_seconds, floor_to
from dockflow.operators.endpoints import endpoint_events
from dockflow.operators.folds import fold_days, grid_size, on_fold_days, stations_by_fold
from dockflow.operators.prepare import between_known, drop_unnamed
from dockflow.params import DEFAULT_BIKES, DEFAULT_CAPACITY, HOUR


def with_clamped_total(
    df: DataFrame, keys: Sequence[str], order: str, net: str, start: Column | float = 0.0, name: str = "bikes"
) -> DataFrame:
    """Add x <- max(0, x + net) within ``keys`` without a loop (Lindley's
    recursion): the running sum plus the larger of the start and its deepest dip."""
    run = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    start = F.lit(float(start)) if isinstance(start, (int, float)) else start
    return (
        df.withColumn("_sum", F.sum(net).over(run))
        .withColumn(name, F.col("_sum") + F.greatest(start, -F.min("_sum").over(run)))
        .drop("_sum")
    )


def _clip(x: Column, low: Column, high: Column) -> Column:
    return F.least(high, F.greatest(low, x))


def with_clamped_walk(
    df: DataFrame, keys: Sequence[str], order: str, net: str, start: Column | float, high: Column | float, low: Column | float = 0.0, block: int = 1024
) -> DataFrame:
    """(*keys, order, net, bikes) with x <- min(high, max(low, x + net)) within
    ``keys``, for walks of any length. ``order`` is a whole number (a step, or hours
    since some time), distinct within a key; start and bounds are constant within a key.

    A step adds and clips, and so does any sequence of steps: a shift between a
    floor and a ceiling. Blocks of ``block`` orders are composed each into one
    such step, the steps of a key's blocks give every block its first value, and
    blocks are then walked apart. A row holds a block's nets, or a key's blocks,
    never a whole walk of nets.
    """
    of = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    low, high, start = (of(v).cast("double") for v in (low, high, start))
    number = F.floor(F.col(order) / F.lit(block))
    blocks = (
        df.select(*keys, number.alias("block"), F.struct(F.col(order).alias("at"), F.col(net).alias("net")).alias("step"), low.alias("low"), high.alias("high"), start.alias("start"))
        .groupBy(*keys, "block")
        .agg(F.sort_array(F.collect_list("step")).alias("steps"), *[F.first(c).alias(c) for c in ("low", "high", "start")])
    )
    step = lambda shift, floor, ceiling: F.struct(shift.alias("shift"), floor.alias("floor"), ceiling.alias("ceiling"))
    lower, upper = F.col("low"), F.col("high")
    still = step(F.lit(0.0), F.lit(float("-inf")), F.lit(float("inf")))
    composed = F.aggregate(
        "steps",
        still,
        lambda f, e: step(f["shift"] + e["net"], _clip(f["floor"] + e["net"], lower, upper), _clip(f["ceiling"] + e["net"], lower, upper)),
    )
    walked = (
        blocks.select(*keys, "start", F.struct("block", composed.alias("f")).alias("b"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("b")).alias("all"), F.first("start").alias("start"))
    )
    after = lambda x, b: _clip(x + b["f"]["shift"], b["f"]["floor"], b["f"]["ceiling"])
    values = F.aggregate("all", F.array("start"), lambda xs, b: F.array_append(xs, after(F.element_at(xs, -1), b)))
    begin = F.slice(values, F.lit(1), F.size("all"))
    firsts = walked.select(*keys, F.inline(F.zip_with("all", begin, lambda b, x: F.struct(b["block"].alias("block"), x.alias("first")))))
    path = F.aggregate(
        "steps",
        F.array("first"),
        lambda xs, e: F.array_append(xs, _clip(F.element_at(xs, -1) + e["net"], lower, upper)),
    )
    reached = F.slice(path, F.lit(2), F.size("steps"))
    cells = F.zip_with("steps", reached, lambda e, x: F.struct(e["at"].alias(order), e["net"].alias(net), x.alias("bikes")))
    return blocks.join(firsts, [*keys, "block"]).select(*keys, F.inline(cells))


def _final_total(nets: Column) -> Column:
    """Last value of the clamped total over an ordered array of structs."""
    return F.aggregate(nets, F.lit(0.0), lambda x, e: F.greatest(F.lit(0.0), x + e["net"]))


def initial_inventory(flows: DataFrame, station_stats: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold_id, station_name, capacity, test_start, test_end, bikes) at the
    start of each test window: the clamped total from 0 over the week before,
    capped at capacity. Without any trip in that week every station gets 15.

    ``folds`` carries ``has_burn_in`` (see ``fold_facts``).
    """
    week = (
        on_fold_days(flows, fold_days(folds, "burn_in"))
        .groupBy("fold_id", "station_name")
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "net"))).alias("nets"))
        .select("fold_id", "station_name", _final_total(F.col("nets")).alias("tracked"))
    )
    base = stations_by_fold(station_stats, folds, "test_start", "test_end", "has_burn_in")
    tracked = F.coalesce(F.col("tracked"), F.lit(0.0))
    start = F.when(F.col("has_burn_in"), tracked).otherwise(F.lit(DEFAULT_BIKES))
    return base.join(week, ["fold_id", "station_name"], "left").select(
        "fold_id",
        "station_name",
        "capacity",
        "test_start",
        "test_end",
        clamp(start, high=F.coalesce("capacity", F.lit(DEFAULT_CAPACITY))).alias("bikes"),
    )


def track_inventory(flows: DataFrame, init: DataFrame, seconds: int = HOUR, windows: DataFrame | None = None) -> DataFrame:
    """Observed inventory over [test_start, test_end): trips of a bucket show
    one step later, so those of the last bucket never do, and there is no
    upper cap. ``flows`` are bucketed by ``seconds``; ``windows`` saves finding
    the distinct windows of ``init``."""
    windows = init if windows is None else windows
    windows = windows.select("fold_id", "test_start", "test_end").distinct()
    step = F.timestamp_diff("SECOND", F.col("test_start"), F.col("bucket")) / F.lit(float(seconds))
    inside = on_fold_days(flows, fold_days(windows, "test", keep=("test_start", "test_end"))).withColumn("_step", step)
    steps = grid_size(F.col("test_start"), F.col("test_end"), seconds)
    nets = (
        inside.where(
            (F.col("_step") >= 0) & (F.col("_step") + 1 < steps) & (F.col("_step") == F.floor("_step"))
        )
        .groupBy("fold_id", "station_name")
        .agg(
            F.sort_array(F.collect_list(F.struct((F.col("_step") + 1).cast("int").alias("step"), "net"))).alias("nets")
        )
    )
    return init.join(nets, ["fold_id", "station_name"], "left").select(
        "fold_id",
        "station_name",
        "capacity",
        F.col("test_start").alias("start_ts"),
        tracked_total(F.col("bikes"), steps, F.col("nets")).alias("bikes"),
    )


def to_long(trajectories: DataFrame, *keys: str, seconds: int = HOUR, value: str = "bikes") -> DataFrame:
    """One row per step: (*keys, fold_id, station_name, capacity, ts, bikes)."""
    return trajectories.select(
        *keys, "fold_id", "station_name", "capacity", "start_ts", F.posexplode("bikes").alias("step", value)
    ).select(
        *keys,
        "fold_id",
        "station_name",
        "capacity",
        add_seconds("start_ts", F.col("step") * seconds).alias("ts"),
        value,
    )


def month_inventory(trips: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """(year, month, station_name, start_bikes, end_bikes) inferred from each
    month's trips.

    Forward and backward passes collapse to one window: the bikes a station
    needs at the start are the deepest dip of its running net flow, and its end
    inventory is start plus net. Only listed stations seen in the month count,
    and only trips between two of them. Without a station list the names of the
    first month are the list.
    """
    month = {"year": F.year("started_at"), "month": F.month("started_at")}
    keys = ["year", "month", "station_name"]
    seen = (
        endpoint_events(trips)
        .where(F.col("station_name").isNotNull())
        .withColumns(month)
        .select(*keys)
        .distinct()
    )
    if stations is not None:
        listed = stations.select(F.col("name").alias("station_name")).where(F.col("station_name").isNotNull()).distinct()
    else:
        stamp = F.col("year") * 12 + F.col("month")
        listed = seen.where(stamp == seen.agg(F.min(stamp)).scalar()).select("station_name").distinct()
    seen = seen.join(listed, "station_name", "left_semi").select(*keys)
    kept = between_known(drop_unnamed(trips), listed)
    hourly = (
        endpoint_events(kept)
        .groupBy("station_name", floor_to("started_at").alias("bucket"))
        .agg((F.sum("arrival") - F.sum("departure")).alias("net"))
        .withColumns({"year": F.year("bucket"), "month": F.month("bucket")})
    )
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    dips = (
        hourly.withColumn("sum", F.sum("net").over(run))
        .groupBy(*keys)
        .agg(F.greatest(F.lit(0), -F.min("sum")).alias("start_bikes"), F.sum("net").alias("net"))
    )
    none = F.lit(0).cast("long")
    start = F.coalesce("start_bikes", none)
    return seen.join(dips, keys, "left").select(
        *keys, start.alias("start_bikes"), (start + F.coalesce("net", none)).alias("end_bikes")
    )


def top_start_inventory(inventory: DataFrame, k: int = 10) -> DataFrame:
    """Each month's ``k`` stations with most bikes at its start."""
    most = Window.partitionBy("year", "month").orderBy(F.desc("start_bikes"), "station_name")
    return inventory.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= k)


def month_inventory_summary(trips: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per month: trips, first and last start, stations, bikes at both ends."""
    loaded = trips.groupBy(F.year("started_at").alias("year"), F.month("started_at").alias("month")).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.min("started_at").alias("start_time"),
        F.max("started_at").alias("end_time"),
    )
    totals = inventory.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.sum("start_bikes").alias("total_bikes_start"),
        F.sum("end_bikes").alias("total_bikes_end"),
    )
    return loaded.join(totals, ["year", "month"])
