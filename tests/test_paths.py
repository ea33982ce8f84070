"""Kernels over whole trajectories against plain loops, and what cross-validation
hands from one operator to the next."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from trip_tables import as_trips, random_trips

from dockflow.functions.paths import clamped_context_walk, clamped_walk, tracked_total
from dockflow.operators import evaluate, flow_models
from dockflow.plans import cross_validation as cv

NAMES = ["Station A", "Station B", "Station C"]


def test_tracked_total_matches_loop(spark):
    rng = np.random.RandomState(3)
    rows = [(0, 4.0, 5, None), (1, None, 4, [(2, -1)]), (2, -2.0, 3, []), (3, 1.0, None, None), (4, 7.0, 0, None), (5, 1.0, 6, [(1, None), (3, 2)])]
    for i in range(6, 1300):
        steps = int(rng.randint(1, 30))
        at = [s for s in range(1, steps) if rng.rand() < 0.4]
        rows.append((i, float(rng.randint(0, 9)), steps, [(s, int(rng.randint(-5, 5))) for s in at]))
    df = spark.createDataFrame(rows, "id int, start double, steps int, nets array<struct<step: int, net: bigint>>")
    got = {r.id: r.path for r in df.select("id", tracked_total(F.col("start"), F.col("steps"), F.col("nets")).alias("path")).collect()}
    for i, x, steps, nets in rows:
        if steps is None:
            assert got[i] is None
            continue
        by, path = dict(nets or []), [x]
        for s in range(1, steps):
            # The greater of 0 and a null is 0, as in SQL.
            x = x if s not in by else 0.0 if x is None or by[s] is None else max(0.0, x + by[s])
            path.append(x)
        assert got[i] == path


@pytest.mark.parametrize("seconds", [3600, 900])
def test_walks_match_loop(spark, seconds):
    rng = np.random.RandomState(4)
    rows = []
    for i in range(1500):
        begin = pd.Timestamp("2025-09-04 22:30") + pd.Timedelta(hours=int(rng.randint(0, 60)))
        seen = [float(rng.normal()) if rng.rand() < 0.5 else None for _ in range(48)]
        start = None if i == 7 else float(rng.rand() * 9)
        rows.append((i, start, float(rng.randint(3, 12)), int(rng.randint(0, 200)), seen if i != 9 else None, 0.25, begin.to_pydatetime()))
    ddl = "id int, start double, high double, steps int, seen array<double>, other double, begin timestamp_ntz"
    df = spark.createDataFrame(rows, ddl)
    c = {n: F.col(n) for n in df.columns}
    walk = clamped_context_walk(c["start"], c["high"], c["steps"], c["seen"], c["other"], c["begin"], seconds)
    got = df.select("id", walk.alias("by_context"), clamped_walk(c["start"], c["high"], c["steps"], c["other"]).alias("even"))
    for r, (_, start, high, steps, seen, other, begin) in zip(got.orderBy("id").collect(), rows):
        x, y = start, start
        by_context, even = [x], [y]
        for k in range(1, steps):
            ts = pd.Timestamp(begin) + pd.Timedelta(seconds=k * seconds)
            own = seen[ts.hour * 2 + (ts.dayofweek >= 5)] if seen else None
            flow = other if own is None else own
            x = min(high, 0.0 if x is None else max(0.0, x + flow))
            y = min(high, 0.0 if y is None else max(0.0, y + other))
            by_context.append(x)
            even.append(y)
        assert r.by_context == by_context and r.even == even


def path_tables(spark):
    """Truth and two models over paths of several lengths, some with gaps, one without a common step."""
    rng, nan = np.random.RandomState(5), float("nan")
    at = pd.Timestamp("2025-09-01").to_pydatetime()
    truth, pred = [], []
    for fold in range(3):
        for i in range(200):
            n, cap = int(rng.choice([24, 24, 24, 7])), None if i == 3 else nan if i == 4 else float(rng.randint(5, 30))
            t = [float(v) for v in rng.randint(0, 30, n)]
            p = [float(v) for v in rng.randint(0, 300, n) / 10]
            if i == 5:
                t[2], p[3], p[4] = None, None, nan
            if i == 6:
                p = p[:5]
            if i == 7:
                p = [None] * n
            truth.append((fold, f"S{i}", cap, at, t))
            pred += [("a", fold, f"S{i}", cap, at, p), ("b", fold, f"S{i}", cap, at, t)]
    ddl = "fold_id int, station_name string, capacity double, start_ts timestamp_ntz, bikes array<double>"
    return spark.createDataFrame(truth, ddl), spark.createDataFrame(pred, f"model string, {ddl}")


def test_metrics_of_paths_equal_metrics_of_steps(spark):
    truth, pred = path_tables(spark)
    of_steps = evaluate.fold_metrics(evaluate.align_paths(truth, pred, "model"), "model")
    of_paths = evaluate.fold_metrics(evaluate.align_paths(truth, pred, "model", whole=True), "model")
    assert of_paths.schema == of_steps.schema
    a, b = (df.orderBy("model", "fold_id").collect() for df in (of_steps, of_paths))
    assert len(a) == len(b) == 6
    for x, y in zip(a, b):
        for c in of_steps.columns:
            same = x[c] == y[c] or (isinstance(x[c], float) and (math.isclose(x[c], y[c], rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(x[c]) and math.isnan(y[c]))))
            assert same, (c, x[c], y[c])


def test_cross_validation_hands_on_paths(spark, monkeypatch):
    """A row per station, fold and model reaches the metrics, not one per step,
    and flows lie by station, so that no operator shuffles them."""
    pdf = random_trips(5, 1500, NAMES, 30)
    stations = spark.createDataFrame([(str(i), s, 20.0 + i) for i, s in enumerate(NAMES)], "station_id string, name string, capacity double")
    data = cv.prepared(as_trips(spark, pdf), stations, 10)
    seen = []
    measured = evaluate.fold_metrics
    monkeypatch.setattr(evaluate, "fold_metrics", lambda pairs, *keys, **more: seen.append(pairs) or measured(pairs, *keys, **more))
    metrics = cv.cross_validate(data, ("persistence", "temporal_flow"), cv.folds_of(data, 2, 1, 7))
    assert {(r.n_stations, r.n_predictions) for r in metrics.collect()} == {(3, 504)}
    assert seen[0].count() == metrics.count() * 3
    counted = data.flows.groupBy("station_name", "bucket").count()
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_mean_of_cancelling_flows_is_zero_in_any_order(spark):
    """Flows that cancel, as those of all stations do: a rest of the addition would
    move a station at a threshold across it."""
    rng = np.random.RandomState(6)
    flows = rng.randint(-40, 41, (4000, 24)) / 40
    rows = [(0, f"{s}{i}", h, False, s_x) for i, row in enumerate(flows) for h, x in enumerate(row) for s, s_x in (("S", float(x)), ("T", float(-x)))]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    params = spark.createDataFrame(rows, "fold_id int, station_name string, hour int, is_weekend boolean, avg_flow double")
    at = [pd.Timestamp(d).to_pydatetime() for d in ("2025-09-06", "2025-09-08")]
    init = spark.createDataFrame([(0, "U", 10.0, *at, 1e-17)], "fold_id int, station_name string, capacity double, test_start timestamp_ntz, test_end timestamp_ntz, bikes double")
    # On a weekend no key was seen, so the station moves with the mean, which is 0.
    path = flow_models.forecast_temporal_flow(params.repartition(7), init).first().bikes
    assert path == [1e-17] * 48
