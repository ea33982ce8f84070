"""Monte Carlo walks over the transition table, one row per simulation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.numeric import poisson_sql, position_sql, uniform_sql
from dockflow.functions.time import add_seconds
from dockflow.operators.markov import NANOS, MarkovFit, run_walk, walk_edges, walk_state
from dockflow.params import HOUR

_KEYS = ["fold_id", "sim_id", "station_name"]
_STEPS_PER_PLAN = 4


def simulate_walks(
    edges: DataFrame | MarkovFit, init: DataFrame, steps: int, n_simulations: int = 50, seed: int = 42, seconds: int = HOUR
) -> DataFrame:
    """(fold_id, sim_id, station_name, step, bikes) of ``n_simulations`` walks.

    Departures are Poisson with the rate scaled by how full the station is, at
    most the whole bikes there; each departing bike finds its own destination by
    a binary search of the running probabilities. Every draw is a hash of (seed,
    fold, simulation, station, time, bike).
    """
    sims = F.explode(F.sequence(F.lit(0), F.lit(n_simulations - 1)))
    state = walk_state(init).withColumn("sim_id", sims)

    drawn_from = ("fold_id", "sim_id", "station_name", "ts")
    leaving = poisson_sql("rate * x / greatest(capacity, 1D)", uniform_sql(seed, *drawn_from, "0"), "floor(x)")
    bike = uniform_sql(seed, *drawn_from, "j")
    found = position_sql("dests", "u", "{}.upto")

    def moves(joined: str) -> str:
        # A row per bike that leaves. Bikes without any known destination leave the network: nothing routes them.
        return f"""SELECT s.* EXCEPT (station_name, rate, dests, leaving, draws), m.* FROM (
                SELECT *, CASE WHEN leaving > 0 THEN transform(sequence(1, leaving), j -> {bike}) ELSE array() END AS draws
                FROM (SELECT *, CASE WHEN rate * x > 0 THEN {leaving} ELSE 0 END AS leaving FROM {joined})) s
            LATERAL VIEW inline(concat(
                array(named_struct('station_name', station_name, 'moved', {NANOS.format('x - leaving')}, 'is_self', true)),
                filter(transform(draws, u -> named_struct('station_name', get(dests, {found}).to_station, 'moved', 1000000000L, 'is_self', false)),
                    b -> b.station_name IS NOT NULL)
            )) m"""

    # Its steps nest deeper than the expected-value walk's; the analyzer takes fewer of them.
    pieces = run_walk(state, _KEYS, walk_edges(edges), steps, seconds, moves, per_plan=_STEPS_PER_PLAN)
    # A piece is labelled with its last step.
    first = F.col("piece") - F.size("values") + 1
    return pieces.select(*_KEYS, first.alias("first"), F.posexplode("values").alias("at", "bikes")).select(
        *_KEYS, (F.col("first") + F.col("at")).alias("step"), "bikes"
    )


def ensemble_bounds(walks: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Mean and percentile bounds over the simulations of each step."""
    return walks.groupBy("fold_id", "station_name", "step").agg(
        F.avg("bikes").alias("mean"),
        F.percentile("bikes", F.lit(low)).alias("lower"),
        F.percentile("bikes", F.lit(high)).alias("upper"),
    )


def forecast_with_uncertainty(
    edges: DataFrame | MarkovFit, init: DataFrame, steps: int, n_simulations: int = 50, seed: int = 42, seconds: int = HOUR
) -> DataFrame:
    """(fold_id, station_name, capacity, ts, mean, lower, upper); always sampled."""
    bounds = ensemble_bounds(simulate_walks(edges, init, steps, n_simulations, seed, seconds))
    keys = ["fold_id", "station_name"]
    return bounds.join(init.select(*keys, "capacity", "test_start"), keys).select(
        *keys,
        "capacity",
        add_seconds("test_start", F.col("step") * seconds).alias("ts"),
        "mean",
        "lower",
        "upper",
    )


def forecast_ensemble(
    edges: DataFrame | MarkovFit, init: DataFrame, steps: int, n_simulations: int = 50, seed: int = 42, seconds: int = HOUR
) -> DataFrame:
    """Mean trajectories over the simulations."""
    walks = simulate_walks(edges, init, steps, n_simulations, seed, seconds)
    keys = ["fold_id", "station_name"]
    paths = (
        walks.groupBy(*keys, "step")
        .agg(F.avg("bikes").alias("bikes"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("step", "bikes"))).alias("path"))
    )
    return paths.join(init.select(*keys, "capacity", "test_start"), keys).select(
        *keys, "capacity", F.col("test_start").alias("start_ts"), F.col("path")["bikes"].alias("bikes")
    )
