"""Transition probabilities and departure rates per (hour, weekend) context, and
the expected-value walk over them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.text import short_label
from dockflow.functions.time import is_weekend
from dockflow.operators.folds import context_days, fold_counts, stations_by_fold, time_grid
from dockflow.params import DEFAULT_CAPACITY, HOUR
from dockflow.session import cut, setting, union_all

CONTEXT = ["fold_id", "hour", "is_weekend"]


class MarkovFit(NamedTuple):
    """edges: (fold_id, hour, is_weekend, from_station, to_station, trips, prob, rate)
    of the contexts with enough pairs, ``rate`` being the origin's departures per day;
    fallback: (fold_id, from_station, to_station, trips, prob, rate) over all contexts;
    contexts: all 48 per fold with n_pairs and ``valid``."""

    edges: DataFrame
    fallback: DataFrame
    contexts: DataFrame


def _probability(*origin: str) -> Column:
    return F.col("trips") / F.sum("trips").over(Window.partitionBy(*origin))


def _departures(*origin: str) -> Column:
    return F.sum("trips").over(Window.partitionBy(*origin))


def fit_markov(od: DataFrame, folds: DataFrame, min_transitions: int = 1) -> MarkovFit:
    """Fit every fold at once from the hourly origin-destination table.

    Trips are counted by running totals over the folds (see ``fold_counts``), so
    what is shuffled doesn't depend on how many training windows a trip lies in.
    The table is laid out by origin and context, in which counting and
    normalising happen where the rows are. It is one row per pair and hour:
    whatever an origin's share of the trips, its 48 contexts lie apart, and each
    holds at most a row per destination and day.

    A context with fewer than ``min_transitions`` distinct pairs uses the
    fallback for both probabilities and rates.
    """
    daily = od.select(
        F.hour("bucket").alias("hour"), is_weekend("bucket").alias("is_weekend"), "from_station", "to_station", F.to_date("bucket").alias("day"), "trips"
    )
    origin = [*CONTEXT, "from_station"]
    keys = ["hour", "is_weekend", "from_station", "to_station"]
    counts = fold_counts(daily, folds, keys, keys[:3])
    days = context_days(folds, od)
    pairs = counts.groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("n_pairs"))
    grid = folds.select("fold_id", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).select(
        "fold_id", "hour", F.explode(F.array(F.lit(False), F.lit(True))).alias("is_weekend")
    )
    n_pairs = F.coalesce("n_pairs", F.lit(0).cast("long"))
    contexts = (
        grid.join(pairs, CONTEXT, "left")
        .join(days, CONTEXT, "left")
        .select(
            *CONTEXT,
            n_pairs.alias("n_pairs"),
            F.coalesce("n_days", F.lit(1).cast("long")).alias("n_days"),
            ((n_pairs >= min_transitions) & (n_pairs > 0)).alias("valid"),
        )
    )
    # 48 rows per fold.
    accepted = F.broadcast(contexts.where("valid").select(*CONTEXT, "n_days"))
    edges = counts.join(accepted, CONTEXT).select(
        *CONTEXT,
        "from_station",
        "to_station",
        "trips",
        _probability(*origin).alias("prob"),
        (_departures(*origin) / F.col("n_days")).alias("rate"),
    )
    whole = ["fold_id", "from_station"]
    fallback = (
        counts.groupBy("fold_id", "from_station", "to_station")
        .agg(F.sum("trips").alias("trips"))
        .join(F.broadcast(folds.select("fold_id", "train_hours")), "fold_id")
        .select(
            *whole,
            "to_station",
            "trips",
            _probability(*whole).alias("prob"),
            (_departures(*whole) / F.greatest("train_hours", F.lit(1))).alias("rate"),
        )
    )
    return MarkovFit(edges, fallback, contexts)


def effective_edges(fit: MarkovFit) -> DataFrame:
    """Edges of all 48 contexts: the context's own, or the fallback's."""
    failing = F.broadcast(fit.contexts.where(~F.col("valid")).select(*CONTEXT))
    columns = [*CONTEXT, "from_station", "to_station", "prob", "rate"]
    return union_all(fit.edges.select(*columns), fit.fallback.join(failing, "fold_id").select(*columns))


def departure_rates(edges: DataFrame) -> DataFrame:
    """(fold_id, hour, is_weekend, station_name, rate) of the stations with departures."""
    return edges.groupBy(*CONTEXT, F.col("from_station").alias("station_name")).agg(F.max("rate").alias("rate"))


def transitions_of(fit: MarkovFit, hour: int, weekend: bool) -> DataFrame:
    """The matrix of one context as edges, with the fallback if it has none."""
    return effective_edges(fit).where((F.col("hour") == hour) & (F.col("is_weekend") == weekend))


def top_destinations(edges: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most likely destinations per origin and context."""
    best = Window.partitionBy(*CONTEXT, "from_station").orderBy(F.desc("prob"), "to_station")
    return (
        edges.where(F.col("prob") > 0)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(*CONTEXT, "from_station", "rank", F.col("to_station").alias("destination"), F.col("prob").alias("probability"))
    )


def busiest_stations(rates: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` stations with the highest rate per context."""
    best = Window.partitionBy(*CONTEXT).orderBy(F.desc("rate"), "station_name")
    return rates.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def route_volumes(edges: DataFrame, busiest: DataFrame, k: int = 5) -> DataFrame:
    """Expected trips per hour on the top routes out of each busy station."""
    top = top_destinations(edges, k)
    busy = busiest.select(*CONTEXT, F.col("station_name").alias("from_station"), "rate")
    return top.join(busy, [*CONTEXT, "from_station"]).withColumn("volume", F.col("rate") * F.col("probability"))


def busy_submatrix(edges: DataFrame, busiest: DataFrame) -> DataFrame:
    """Probabilities among the busy stations of a context, zeros included.

    ``busiest`` holds k names per context, so the pairs are k*k per context.
    """
    names = busiest.groupBy(*CONTEXT).agg(F.sort_array(F.collect_list("station_name")).alias("names"))
    pairs = names.select(*CONTEXT, F.explode("names").alias("from_station"), "names").select(
        *CONTEXT, "from_station", F.explode("names").alias("to_station")
    )
    return pairs.join(edges.select(*CONTEXT, "from_station", "to_station", "prob"), [*CONTEXT, "from_station", "to_station"], "left").select(
        *CONTEXT,
        "from_station",
        "to_station",
        short_label("from_station").alias("from_label"),
        short_label("to_station").alias("to_label"),
        F.coalesce("prob", F.lit(0.0)).alias("prob"),
    )


def hourly_activity(rates: DataFrame) -> DataFrame:
    """Total departures per hour and day type."""
    return rates.groupBy(*CONTEXT).agg(F.sum("rate").alias("total_trips_per_hour")).select(
        "fold_id",
        "hour",
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "total_trips_per_hour",
    )


def context_statistics(edges: DataFrame, rates: DataFrame, n_stations: Column) -> DataFrame:
    """Non-zeros, density and sparsity of each context's matrix, and the mean,
    maximum and sum of its rates. The mean is over all stations, those without
    departures included."""
    cells = edges.groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("n_nonzero"))
    rate = rates.groupBy(*CONTEXT).agg(F.sum("rate").alias("total_rate"), F.max("rate").alias("max_rate"))
    density = F.col("n_nonzero") / (n_stations * n_stations)
    return cells.join(rate, CONTEXT).select(
        *CONTEXT,
        "n_nonzero",
        density.alias("density"),
        (F.lit(1.0) - density).alias("sparsity"),
        (F.col("total_rate") / n_stations).alias("avg_rate"),
        "max_rate",
        "total_rate",
    )


def residential_stations(rates: DataFrame, k: int = 5, morning: int = 8, evening: int = 17) -> DataFrame:
    """Stations with the largest weekday excess of morning over evening departures."""
    at = lambda h: F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("rate"))), F.lit(0.0))
    rated = (
        rates.where(~F.col("is_weekend") & F.col("hour").isin(morning, evening))
        .groupBy("fold_id", "station_name")
        .agg(at(morning).alias("morning_rate"), at(evening).alias("evening_rate"))
        .withColumn("difference", F.col("morning_rate") - F.col("evening_rate"))
    )
    best = Window.partitionBy("fold_id").orderBy(F.desc("difference"), "station_name")
    return rated.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def markov_report(fit: MarkovFit, n_stations: Column) -> DataFrame:
    """Per fold: accepted contexts and the mean sparsity of their matrices."""
    cells = fit.edges.groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("n_nonzero"))
    sparsity = F.lit(1.0) - F.col("n_nonzero") / (n_stations * n_stations)
    return cells.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n_transition_matrices"), F.avg(sparsity).alias("avg_sparsity")
    )


def context_net_flow(edges: DataFrame) -> DataFrame:
    """(fold_id, hour, is_weekend, station_name, net_flow): expected arrivals
    less departures at the full departure rates."""
    arrivals = edges.select(*CONTEXT, F.col("to_station").alias("station_name"), (F.col("prob") * F.col("rate")).alias("flow"))
    departures = departure_rates(edges).select(*CONTEXT, "station_name", (-F.col("rate")).alias("flow"))
    return union_all(arrivals, departures).groupBy(*CONTEXT, "station_name").agg(F.sum("flow").alias("net_flow"))


def forecast_net_flow(edges: DataFrame, station_stats: DataFrame, windows: DataFrame, seconds: int = HOUR) -> DataFrame:
    """(fold_id, station_name, ts, net_flow) over each window; stations without
    traffic in a context get 0."""
    grid = stations_by_fold(station_stats, windows, "test_start", "test_end").select(
        "fold_id", "station_name", F.explode(time_grid(F.col("test_start"), F.col("test_end"), seconds)).alias("ts")
    )
    keyed = grid.withColumns({"hour": F.hour("ts"), "is_weekend": is_weekend("ts")})
    return keyed.join(context_net_flow(edges), [*CONTEXT, "station_name"], "left").select(
        "fold_id", "station_name", "ts", F.coalesce("net_flow", F.lit(0.0)).alias("net_flow")
    )


# -- walks --------------------------------------------------------------------

_STEPS_PER_PLAN = 8
#: SQL text of bikes as whole billionths of one.
NANOS = "CAST(round(({}) * 1e9D) AS BIGINT)"
#: State rows and moves that one task of a step takes before there is another.
_ROWS_PER_TASK, _MOVES_PER_TASK = 2_000, 500_000
#: Number of the matrix that contexts without one of their own share.
_FALLBACK = 48


class WalkEdges(NamedTuple):
    """rows: (fold_id, from_station, matrix, rate, dests), ``matrix`` being a
    context (hour, plus 24 on weekends) or the fold's fallback; own: per fold a
    number whose bit i says that context i has a matrix of its own; n: all
    destinations."""

    rows: DataFrame
    own: DataFrame
    n: int


def _context(hour: Column | str, weekend: Column | str) -> Column:
    hour, weekend = (F.col(c) if isinstance(c, str) else c for c in (hour, weekend))
    return (hour + F.when(weekend, 24).otherwise(0)).cast("int")


def walk_edges(edges: DataFrame | MarkovFit) -> WalkEdges:
    """Edges as a walk reads them: one row per fold, origin and matrix. ``dests``
    holds (to_station, prob, upto) in name order, ``upto`` being the running
    probability, 1 at the last.

    Of a fit the fallback is kept once per fold, and contexts without a matrix
    point to it; a table of edges stands for itself. Rows are sorted by matrix
    within the parts in which they lie, and the cache keeps each batch's least and greatest
    one, so that a step reads the batches of its own contexts only.
    """
    if isinstance(edges, MarkovFit):
        columns = ["fold_id", "from_station", "matrix", "to_station", "prob", "rate"]
        numbered = union_all(
            edges.edges.withColumn("matrix", _context("hour", "is_weekend")).select(*columns),
            edges.fallback.withColumn("matrix", F.lit(_FALLBACK)).select(*columns),
        )
        known = edges.contexts.where("valid").select("fold_id", _context("hour", "is_weekend").alias("matrix"))
    else:
        numbered = edges.withColumn("matrix", _context("hour", "is_weekend"))
        known = numbered.select("fold_id", "matrix").distinct()
    origin = ["fold_id", "from_station", "matrix"]
    along = Window.partitionBy(*origin).orderBy("to_station")
    summed = F.sum("prob").over(along.rowsBetween(Window.unboundedPreceding, 0))
    upto = F.when(F.lead("to_station").over(along).isNull(), F.lit(1.0)).otherwise(summed)
    dests = F.sort_array(F.collect_list(F.struct("to_station", "prob", "upto")))
    rows = cut(numbered.withColumn("upto", upto).groupBy(*origin).agg(F.max("rate").alias("rate"), dests.alias("dests")))
    n = rows.agg(F.sum(F.size("dests"))).first()[0] or 0
    return WalkEdges(rows, known.groupBy("fold_id").agg(F.expr("bit_or(shiftleft(1L, matrix))").alias("own")), n)


def walk_state(init: DataFrame) -> DataFrame:
    """State before the first step; stations without a given value start at 0."""
    return init.select(
        "fold_id",
        "station_name",
        F.col("test_start").alias("ts"),
        F.coalesce("capacity", F.lit(DEFAULT_CAPACITY)).alias("capacity"),
        F.coalesce("bikes", F.lit(0.0)).cast("double").alias("x0"),
    )


def _contexts_at(starts: list[datetime], seconds: int) -> list[int]:
    """The contexts in which walks that began at ``starts`` are after so many seconds."""
    now = [t + timedelta(seconds=seconds) for t in starts]
    return sorted({t.hour + 24 * (t.weekday() >= 5) for t in now})


def run_walk(
    state: DataFrame, keys: list[str], edges: WalkEdges, steps: int, seconds: int, moves: Callable[[str], str], per_plan: int = _STEPS_PER_PLAN
) -> DataFrame:
    """Walk ``steps`` values from ``state`` and return (*keys, piece, values): the
    path of each key in pieces labelled with their last step.

    ``moves(joined)`` is SQL text over the state joined with its origin's row for
    the current context (bikes ``x``, ``rate``, ``dests``, both null for origins
    without departures) that gives rows
    (station_name, moved, is_self, other state columns). A step sums ``moved``
    per key, rounded to nine digits as sums differ in their last ones with the
    order of addition, and clips it to [0, capacity]; the values of earlier steps ride along
    on the self rows, so each step reads the state once and plans grow linearly.
    Every ``per_plan`` steps the lineage is cut.

    There is one plan for every size: edges lie by (fold, origin) and stay there,
    the state meets the rows of its contexts, and only what moved travels, by
    (fold, station). The number of tasks follows the rows of a step.
    """
    spark = state.sparkSession
    state = cut(state.join(edges.own, "fold_id", "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long"))))
    starts = [r[0] for r in state.select("ts").distinct().collect()]  # folds at most
    n_rows = state.count()
    wanted = 1 + max(n_rows // _ROWS_PER_TASK, edges.n // (_FALLBACK * _MOVES_PER_TASK))
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    table = edges.rows.repartition(parts, "fold_id", "from_station").sortWithinPartitions("matrix").persist()
    by, own_columns = ", ".join(keys), ("ts", "capacity", "own")

    def step(before: DataFrame, n: int, number: int) -> DataFrame:
        """The state after one more step; ``x0`` to ``x{n - 1}`` are known."""
        known = [f"x{i}" for i in range(n)]
        carried = ", ".join(f"max(CASE WHEN is_self THEN {c} END) AS {c}" for c in (*own_columns, *known))
        contexts = ", ".join(map(str, [*_contexts_at(starts, number * seconds), _FALLBACK]))
        at = f"""(SELECT *, CASE WHEN (shiftright(own, now) & 1L) = 1 THEN now ELSE {_FALLBACK} END AS matrix, x{n - 1} AS x FROM (
            SELECT *, hour(ts) + CASE WHEN weekday(ts) IN (5, 6) THEN 24 ELSE 0 END AS now FROM (
            SELECT * EXCEPT (ts), timestampadd(SECOND, {int(seconds)}, ts) AS ts FROM {{before}})))"""
        # Two inequalities: an equality would become a key, and the table is laid out by fold and origin.
        joined = f"""(SELECT /*+ SHUFFLE_HASH(e) */ s.*, e.rate, e.dests FROM {at} s
            LEFT JOIN (SELECT * FROM {{table}} WHERE matrix IN ({contexts})) e
            ON e.fold_id = s.fold_id AND e.from_station = s.station_name AND e.matrix <= s.matrix AND e.matrix >= s.matrix)"""
        query = f"""SELECT *, greatest(0D, least(capacity, total / 1e9D)) AS x{n} FROM (
            SELECT {by}, {carried}, sum(moved) AS total FROM (
                SELECT /*+ REPARTITION({parts}, fold_id, station_name) */ * FROM ({moves(joined)})) GROUP BY {by})"""
        return spark.sql(query, before=before, table=table).drop("total")

    pieces = [state.select(*keys, F.lit(0).alias("piece"), F.array("x0").alias("values"))]
    done = 0
    while done < steps - 1:
        upto = min(done + per_plan, steps - 1)
        n = upto - done
        # The plan is fixed and its tables are laid out: nothing is left to adapt between steps.
        with setting(spark, "spark.sql.adaptive.enabled", "false"), setting(spark, "spark.sql.shuffle.partitions", str(parts)):
            for i in range(1, n + 1):
                state = step(state, i, done + i)
            state = cut(state)
        values = F.array(*[f"x{i}" for i in range(1, n + 1)])
        pieces.append(state.select(*keys, F.lit(upto).alias("piece"), values.alias("values")))
        state = state.select(*keys, *own_columns, F.col(f"x{n}").alias("x0"))
        done = upto
    table.unpersist()
    return union_all(*pieces)


def forecast_markov(edges: DataFrame | MarkovFit, init: DataFrame, steps: int, seconds: int = HOUR) -> DataFrame:
    """Expected-value trajectories of ``steps`` values for all folds together.

    ``init``: (fold_id, station_name, capacity, test_start, bikes). Departures
    are the rate or what is there, whichever is less; arrivals follow the
    probabilities; the result is clipped to [0, capacity]. All stations move
    together, so this is a loop over steps, but its state is only folds x
    stations rows and goes to the edges, which stay where they were written.
    """
    keys = ["fold_id", "station_name"]

    def moves(joined: str) -> str:
        return f"""SELECT s.* EXCEPT (station_name, rate, dests), m.* FROM {joined} s
            LATERAL VIEW inline(concat(
                array(named_struct('station_name', station_name, 'moved', {NANOS.format('x - least(coalesce(rate, 0D), x)')}, 'is_self', true)),
                coalesce(transform(dests, d -> named_struct('station_name', d.to_station, 'moved', {NANOS.format('d.prob * least(rate, x)')}, 'is_self', false)), array())
            )) m"""

    pieces = run_walk(walk_state(init), keys, walk_edges(edges), steps, seconds, moves)
    paths = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("piece", "values"))).alias("pieces"))
    return paths.join(init.select(*keys, "capacity", "test_start"), keys).select(
        *keys, "capacity", F.col("test_start").alias("start_ts"), F.flatten(F.col("pieces")["values"]).alias("bikes")
    )
