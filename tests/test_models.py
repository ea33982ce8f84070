"""Fits, forecasts and metrics on seeded trips: published values, loops written
in plain Python, and invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from trip_tables import as_trips, random_trips

from dockflow.operators import endpoints, ensemble, evaluate, flow_models, folds, inventory, markov
from dockflow.plans import cross_validation as cv

NAMES = ["Station A", "Station B", "Station C"]
CAPS = {"Station A": 30.0, "Station B": 25.0, "Station C": 40.0}
START = {"Station A": 15.0, "Station B": 12.0, "Station C": 20.0}


@pytest.fixture(scope="module")
def trips():
    return random_trips(12345, 500, NAMES, 14)


@pytest.fixture(scope="module")
def data(spark, trips):
    od = endpoints.od_by_hour(as_trips(spark, trips)).persist()
    stats = spark.createDataFrame(list(CAPS.items()), "station_name string, capacity double")
    return cv.Prepared(od, endpoints.flow_from_od(od), stats)


@pytest.fixture(scope="module")
def whole(data):
    return cv.resident(cv.fit_everything(data))


def window(spark, start, end):
    rows = [(0, s, CAPS[s], pd.Timestamp(start).to_pydatetime(), pd.Timestamp(end).to_pydatetime(), b) for s, b in START.items()]
    return spark.createDataFrame(
        rows, "fold_id int, station_name string, capacity double, test_start timestamp_ntz, test_end timestamp_ntz, bikes double"
    )


def paths(df):
    return {r.station_name: list(r.bikes) for r in df.collect()}


def weekend(ts):
    return ts.dayofweek >= 5


def loop_flows(trips):
    hour, wk = trips.started_at.dt.hour, trips.started_at.dt.dayofweek >= 5
    net = {}
    for s, e, h, w in zip(trips.start_station_name, trips.end_station_name, hour, wk):
        net[s, h, w] = net.get((s, h, w), 0) - 1
        net[e, h, w] = net.get((e, h, w), 0) + 1
    dates = pd.DataFrame({"d": trips.started_at.dt.date, "w": wk}).drop_duplicates()
    n = {w: max((dates.w == w).sum(), 1) for w in (True, False)}
    return {k: v / n[k[2]] for k, v in net.items()}


def test_temporal_flow_fit_and_forecast(spark, data, whole, trips):
    params = flow_models.fit_temporal_flow(data.flows, whole)
    got = {(r.station_name, r.hour, r.is_weekend): r.avg_flow for r in params.collect()}
    expected = loop_flows(trips)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    overall = np.mean(list(expected.values()))
    init = window(spark, "2025-09-15 08:00:00", "2025-09-15 14:00:00")
    result = paths(flow_models.forecast_temporal_flow(params, init))
    for s in NAMES:
        x, path = START[s], [START[s]]
        for h in range(9, 14):
            x = min(CAPS[s], max(0.0, x + expected.get((s, h, False), overall)))
            path.append(x)
        assert np.allclose(result[s], path)


def test_end_to_end_metrics(spark, data, whole):
    """Published values: MAE 2.175, RMSE 3.068795."""
    init = window(spark, "2025-09-10", "2025-09-11")
    pred = flow_models.forecast_temporal_flow(flow_models.fit_temporal_flow(data.flows, whole), init)
    truth = inventory.track_inventory(data.flows, init)
    row = evaluate.fold_metrics(evaluate.align_paths(truth, pred)).first()
    assert abs(row.inventory_mae - 2.175) < 0.1
    assert abs(row.inventory_rmse - 3.068795) < 0.1


def test_metric_values(spark):
    """Published values of the 3 x 24 case."""
    np.random.seed(42)
    true = np.random.randint(5, 25, size=(3, 24))
    np.random.seed(43)
    pred = np.clip(true + np.random.randint(-3, 4, size=(3, 24)), 0, 30)
    rows = [
        (0, s, CAPS[s], pd.Timestamp("2025-09-01").to_pydatetime() + pd.Timedelta(hours=j).to_pytimedelta(), float(true[i, j]), float(pred[i, j]))
        for i, s in enumerate(NAMES)
        for j in range(24)
    ]
    pairs = spark.createDataFrame(rows, "fold_id int, station_name string, capacity double, ts timestamp_ntz, true double, pred double")
    row = evaluate.fold_metrics(pairs).first()
    assert abs(row.inventory_mae - 1.569444) < 1e-6
    assert abs(row.inventory_rmse - 1.889297) < 1e-6
    assert abs(row.correlation - 0.951243) < 1e-6
    assert abs(row.state_accuracy - 0.986111) < 1e-6
    constant = evaluate.fold_metrics(pairs.withColumn("pred", F.lit(7.1))).first()
    assert constant.correlation == 0.0


def test_states(spark):
    rows = [("A", 30.0, b) for b in (2, 5, 15, 27, 29)] + [("B", 25.0, b) for b in (1, 3, 12, 22, 24)] + [("Z", 0.0, 0)]
    df = spark.createDataFrame([(s, c, float(b)) for s, c, b in rows], "station_name string, capacity double, bikes double")
    got = [r.state for r in flow_models.forecast_states(df, 0.1, 0.9).collect()]
    assert got == ["empty", "normal", "normal", "full", "full", "empty", "normal", "normal", "normal", "full", "empty"]
    odd = spark.createDataFrame([(30.0, float("nan"))], "capacity double, bikes double")
    assert flow_models.forecast_states(odd, 0.1, 0.9).first().state == "normal"


def test_tracker_matches_loop(spark, data, trips):
    init = window(spark, "2025-09-03", "2025-09-06")
    got = paths(inventory.track_inventory(data.flows, init))
    hours = pd.date_range("2025-09-03", "2025-09-06", freq="1h", inclusive="left")
    for s in NAMES:
        x, path = START[s], [START[s]]
        for t in hours[:-1]:
            now = trips[trips.started_at == t]
            x = max(0.0, x - (now.start_station_name == s).sum() + (now.end_station_name == s).sum())
            path.append(x)
        assert got[s] == path


def test_tracker_without_trips_is_constant(spark, data):
    got = paths(inventory.track_inventory(data.flows, window(spark, "2026-01-05", "2026-01-06")))
    assert all(got[s] == [START[s]] * 24 for s in NAMES)


def test_initial_inventory_default(spark, data):
    rows = [(0, pd.Timestamp("2027-01-01").to_pydatetime(), pd.Timestamp("2027-01-08").to_pydatetime(), False)]
    no_trips = spark.createDataFrame(rows, "fold_id int, test_start timestamp_ntz, test_end timestamp_ntz, has_burn_in boolean")
    assert {r.bikes for r in inventory.initial_inventory(data.flows, data.stations, no_trips).collect()} == {15.0}


def numpy_markov(trips, min_transitions=1):
    idx = {s: i for i, s in enumerate(NAMES)}
    f, t = trips.start_station_name.map(idx).to_numpy(), trips.end_station_name.map(idx).to_numpy()
    hour, wk = trips.started_at.dt.hour.to_numpy(), (trips.started_at.dt.dayofweek >= 5).to_numpy()
    date = trips.started_at.dt.date.to_numpy()

    def matrix(mask, days):
        counts = np.zeros((3, 3))
        np.add.at(counts, (f[mask], t[mask]), 1)
        out = counts.sum(1)
        return np.divide(counts, out[:, None], where=out[:, None] > 0, out=np.zeros_like(counts)), out / days, (counts > 0).sum()

    everything = matrix(np.ones(len(f), bool), trips.started_at.dt.floor("h").nunique())
    contexts = {}
    for h in range(24):
        for w in (False, True):
            mask = (hour == h) & (wk == w)
            if mask.any():
                p, rate, pairs = matrix(mask, len(set(date[mask])))
                if pairs >= min_transitions:
                    contexts[h, w] = (p, rate)
    return contexts, everything


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("min_transitions, start, seconds", [(1, "2025-09-13 20:00:00", 3600), (7, "2025-09-13 20:00:00", 3600), (7, "2025-09-14 22:30:00", 1800)])
def test_markov_walk_matches_numpy(spark, data, whole, trips, min_transitions, start, seconds, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    fit = markov.fit_markov(data.od, whole, min_transitions)
    edges = markov.effective_edges(fit)
    contexts, fallback = numpy_markov(trips, min_transitions)
    assert fit.contexts.where("valid").count() == len(contexts)
    if min_transitions == 1:
        assert len(contexts) == 48 and fit.fallback.count() == 9
    sums = edges.groupBy("hour", "is_weekend", "from_station").agg(F.sum("prob").alias("p")).collect()
    assert all(abs(r.p - 1) < 1e-9 for r in sums)
    init = window(spark, start, "2025-09-16")
    got = paths(markov.forecast_markov(edges, init, 12, seconds))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    x, cap = np.array([START[s] for s in NAMES]), np.array([CAPS[s] for s in NAMES])
    expected = [x]
    for ts in pd.date_range(start, periods=12, freq=f"{seconds}s")[1:]:
        p, rate = contexts.get((ts.hour, weekend(ts)), fallback[:2])
        d = np.minimum(rate, x)
        x = np.clip(x - d + p.T @ d, 0, cap)
        expected.append(x)
    assert np.allclose(np.array([got[s] for s in NAMES]).T, np.array(expected))


def test_markov_conserves_bikes_without_caps(spark, data, whole):
    edges = markov.effective_edges(markov.fit_markov(data.od, whole))
    init = window(spark, "2025-09-08", "2025-09-09").withColumn("capacity", F.lit(1e9))
    got = np.array(list(paths(markov.forecast_markov(edges, init, 10)).values()))
    assert np.allclose(got.sum(0), sum(START.values()))


def test_net_flow_matches_numpy(spark, data, whole, trips):
    edges = markov.effective_edges(markov.fit_markov(data.od, whole))
    flows = {(r.hour, r.is_weekend, r.station_name): r.net_flow for r in markov.context_net_flow(edges).collect()}
    for (h, w), (p, rate) in numpy_markov(trips)[0].items():
        expected = p.T @ rate - rate
        for i, s in enumerate(NAMES):
            assert abs(flows.get((h, w, s), 0.0) - expected[i]) < 1e-9


def test_ensemble(spark, data, whole):
    edges = markov.effective_edges(markov.fit_markov(data.od, whole))
    init = window(spark, "2025-09-08 07:00:00", "2025-09-09").withColumn("capacity", F.lit(1e6) * 0 + F.col("capacity"))
    walks = ensemble.simulate_walks(edges, init, 5, 40, seed=7)
    rows = walks.collect()
    again = ensemble.simulate_walks(edges, init, 5, 40, seed=7).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    total = {}
    for r in rows:
        assert r.bikes == int(r.bikes) and 0 <= r.bikes <= CAPS[r.station_name]
        total[r.sim_id, r.step] = total.get((r.sim_id, r.step), 0) + r.bikes
    assert len(total) == 200 and max(total.values()) <= sum(START.values())
    assert len({r.bikes for r in rows if r.step == 4 and r.station_name == "Station A"}) > 1
    bounds = ensemble.forecast_with_uncertainty(edges, init, 5, 40, seed=7).collect()
    assert len(bounds) == 15 and all(b.lower <= b.mean <= b.upper for b in bounds)


def test_poisson_moments(spark):
    from dockflow.functions.numeric import poisson_sql, uniform_sql

    draws = spark.range(40000).select(F.expr(poisson_sql("3D", uniform_sql(1, "id"), "1000D")).alias("k"))
    row = draws.agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).first()
    assert abs(row.m - 3) < 0.05 and abs(row.v - 3) < 0.1
    capped = spark.range(100).select(F.expr(poisson_sql("900D", uniform_sql(1, "id"), "4D")).alias("k"))
    assert {r.k for r in capped.collect()} == {4}


def test_draws_and_slices(spark):
    """Draws are the leading bits of an MD5, and a binary search finds their slice; large rates don't take the whole stock."""
    import hashlib

    from dockflow.functions.numeric import poisson_sql, position_sql, uniform_sql

    got = spark.range(50).select("id", F.expr(uniform_sql(9, "id", "'x'")).alias("u")).collect()
    assert all(r.u == int(hashlib.md5(f"9|{r.id}|x".encode()).hexdigest()[:13], 16) / 2**52 for r in got)
    for n in range(6):
        upto = [(i + 1) / n for i in range(n)]
        table = spark.range(40).select((F.col("id") / 40).alias("u"), F.array(*[F.lit(x) for x in upto]).cast("array<double>").alias("a"))
        assert all(r.i == sum(x <= r.u for x in upto) for r in table.select("u", F.expr(position_sql("a", "u")).alias("i")).collect())
    row = spark.range(2000).select(F.expr(poisson_sql("900D", uniform_sql(1, "id"), "2000D")).alias("k")).agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).first()
    assert abs(row.m - 900) < 3 and abs(row.v - 900) < 120


def test_fold_counts_equal_joins(spark):
    """Running totals over overlapping folds of three lengths, and a fold without trips."""
    rng = np.random.RandomState(2)
    rows = [(f"s{rng.randint(3)}", f"s{rng.randint(4)}", pd.Timestamp("2025-09-01") + pd.Timedelta(days=int(d)), int(rng.randint(1, 5))) for d in rng.randint(0, 40, 300)]
    daily = spark.createDataFrame([(a, b, d.date(), n) for a, b, d, n in rows], "a string, b string, day date, trips long")
    windows = [(i, i % 30, (3, 7, 14)[i % 3]) for i in range(60)] + [(99, 500, 7)]
    day = lambda k: pd.Timestamp("2025-08-25") + pd.Timedelta(days=k)
    table = spark.createDataFrame([(f, day(a).to_pydatetime(), day(a + n).to_pydatetime()) for f, a, n in windows], "fold_id int, train_start timestamp_ntz, train_end timestamp_ntz")
    got = {(r.fold_id, r.a, r.b): r.trips for r in folds.fold_counts(daily, table, ["a", "b"], ["a"]).collect()}
    want = {}
    for f, start, n in windows:
        for a, b, d, k in rows:
            if day(start) <= d < day(start + n):
                want[f, a, b] = want.get((f, a, b), 0) + k
    assert got == want


def test_walk_reads_the_contexts_of_its_steps(spark, data, whole):
    """The fallback is stored once, contexts without a matrix point to it, and a fit walks like its edges."""
    fit = markov.fit_markov(data.od, whole, 7)
    laid = markov.walk_edges(fit)
    assert laid.rows.where(f"matrix = {markov._FALLBACK}").count() == fit.fallback.select("from_station").distinct().count()
    assert laid.rows.count() < markov.walk_edges(markov.effective_edges(fit)).rows.count()
    init = window(spark, "2025-09-13 20:00:00", "2025-09-16")
    assert paths(markov.forecast_markov(fit, init, 12)) == paths(markov.forecast_markov(markov.effective_edges(fit), init, 12))
    assert markov._contexts_at([pd.Timestamp("2025-09-13 20:00:00"), pd.Timestamp("2025-09-15")], 5 * 3600) == [5, 25]


def test_correlation_keeps_its_digits(spark):
    """Values near 10^9 that deviate by 1, at two levels."""
    rng = np.random.RandomState(1)
    small = {s: (rng.normal(0, 1, 200).round(6) + i, rng.normal(0, 1, 200).round(6) + 2 * i) for i, s in enumerate(NAMES)}
    rows = [(0, s, 1e10, pd.Timestamp("2025-01-01").to_pydatetime(), *[(1e9 + x).tolist() for x in v]) for s, v in small.items()]
    table = spark.createDataFrame(rows, "fold_id int, station_name string, capacity double, start_ts timestamp_ntz, t array<double>, p array<double>")
    pairs = evaluate.align_paths(table.withColumnRenamed("t", "bikes"), table.withColumnRenamed("p", "bikes"))
    got = evaluate.fold_metrics(pairs).first()
    exact = [np.concatenate([(1e9 + v[k]) - 1e9 for v in small.values()]) for k in (0, 1)]
    assert abs(got.correlation - np.corrcoef(*exact)[0, 1]) < 1e-9
    assert abs(got.inventory_rmse - np.sqrt(np.mean((exact[0] - exact[1]) ** 2))) < 1e-9


def test_persistence_and_unknown_model(spark):
    got = paths(flow_models.forecast_persistence(window(spark, "2025-09-15", "2025-09-16")))
    assert all(got[s] == [START[s]] * 24 for s in NAMES)
    assert cv.model_name("baseline") == "temporal_flow"
    with pytest.raises(ValueError):
        cv.model_name("station_average")


def test_folds(spark):
    pdf = random_trips(42, 1000, NAMES, 42)
    rows = folds.rolling_folds(as_trips(spark, pdf), 2, 1, None).orderBy("fold_id").collect()
    first, last = pdf.started_at.min().normalize(), pdf.started_at.max().normalize()
    expected, start = [], first
    while start + pd.Timedelta(weeks=3) <= last:
        expected.append(start)
        start += pd.Timedelta(days=7)
    assert [pd.Timestamp(r.train_start) for r in rows] == expected
    assert all(r.train_end == r.test_start and (r.test_end - r.test_start).days == 7 for r in rows)
    assert folds.rolling_folds(as_trips(spark, pdf), 8, 1).count() == 0


def test_cross_validation_all_models(spark):
    pdf = random_trips(5, 1500, NAMES + ["Station D"], 30)
    stations = spark.createDataFrame(
        [(str(i), s, 20.0 + i) for i, s in enumerate(NAMES)], "station_id string, name string, capacity double"
    )
    metrics, summary = cv.run_cross_validation(
        as_trips(spark, pdf), stations, ("persistence", "station_avg", "baseline"), 2, 1, 7, min_trips=10
    )
    rows = metrics.collect()
    assert len(rows) == 6
    assert all(r.n_stations == 4 and r.n_time_periods == 168 and r.n_predictions == 672 for r in rows)
    assert all(0 <= r.state_accuracy <= 1 and r.inventory_rmse >= r.inventory_mae for r in rows)
    assert summary.where("metric = 'inventory_mae'").count() == 3
