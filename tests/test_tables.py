"""Sources, preparation, quantiles and clamped totals on small fixtures."""

import csv
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from trip_tables import as_trips, random_trips

from dockflow.functions.text import name_contains, short_label
from dockflow.operators import compare, endpoints, inventory, prepare, quality, quantiles, query, stations
from dockflow.operators.quantiles import exact_quantiles
from dockflow.plans import monthly
from dockflow.schema import TRIPS
from dockflow.session import cut
from dockflow.sources import results
from dockflow.sources import stations as station_source
from dockflow.sources import trips as trip_source

COLUMNS = [f.name for f in TRIPS.fields]


def write_csv(path, rows, columns=COLUMNS):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, columns)
        writer.writeheader()
        writer.writerows(rows)


def trip(i, start, name="A", station_id="12.3"):
    return {
        "ride_id": f"r{i}",
        "rideable_type": "classic_bike",
        "started_at": start,
        "ended_at": start,
        "start_station_name": name,
        "start_station_id": station_id,
        "end_station_name": "B",
        "end_station_id": "JC001",
        "start_lat": "40.7",
        "start_lng": "-74.0",
        "end_lat": "40.8",
        "end_lng": "-74.1",
        "member_casual": "member",
    }


@pytest.fixture(scope="module")
def csv_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    write_csv(root / "202504-tripdata" / "202504-tripdata_1.csv", [trip(i, f"2025-04-0{i + 1} 10:00:00") for i in range(3)])
    reordered = list(reversed(COLUMNS))
    write_csv(root / "202504-tripdata" / "202504-tripdata_2.csv", [trip(9, "2025-04-30 23:59:59.5", station_id="7")], reordered)
    write_csv(root / "202505-tripdata" / "202505-tripdata_1.csv", [trip(20, "2025-05-02 00:00:00"), trip(21, "2025-05-03 08:00:00")])
    return root


def test_convert_merges_parts_and_is_idempotent(spark, csv_root, tmp_path):
    target = str(tmp_path / "parquet" / "trips")
    for _ in range(2):
        audit = monthly.convert_months(spark, str(csv_root), target)
        rows = {(r.year, r.month): r for r in audit.collect()}
    assert rows[2025, 4].csv_rows == rows[2025, 4].parquet_rows == 4 and rows[2025, 4].parts == 2
    assert rows[2025, 5].parquet_rows == 2 and all(r.success for r in rows.values())
    totals = trip_source.audit_totals(audit).first()
    assert (totals.successful, totals.failed, totals.total_rows) == (2, 0, 6)
    back = trip_source.read_trips(spark, str(tmp_path), "2025-04-02", "2025-05-02")
    assert sorted(r.ride_id for r in back.collect()) == ["r1", "r2", "r20", "r9"]
    assert "PushedFilters: [IsNotNull(started_at)" in back._jdf.queryExecution().executedPlan().toString()
    assert {r.start_station_id for r in back.collect()} == {"12.3", "7"}
    pruned = trip_source.read_trips_parquet(spark, f"{tmp_path}/parquet/trips", "2025-04-02", "2025-05-02", filed_by_start=True)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(started_at)" in plan
    assert sorted(r.ride_id for r in pruned.collect()) == ["r1", "r2", "r20", "r9"]


def test_trips_filed_under_another_month_are_read(spark, tmp_path):
    late = [trip(1, "2025-04-30 23:50:00"), trip(2, "2025-05-01 00:10:00")]
    write_csv(tmp_path / "csv" / "202505-tripdata_1.csv", late)
    target = str(tmp_path / "parquet" / "trips")
    monthly.convert_months(spark, str(tmp_path / "csv"), target)
    for whole_end_day, want in ((False, []), (True, ["r1"])):
        for read, root in ((trip_source.read_trips_parquet, target), (trip_source.read_trips_csv, str(tmp_path / "csv"))):
            got = read(spark, root, "2025-04-01", "2025-04-30", whole_end_day=whole_end_day)
            assert sorted(r.ride_id for r in got.collect()) == want


def test_manifest_opens_only_what_the_range_needs(spark, csv_root, tmp_path):
    """The May part holds a late April trip, so an April range opens it and not June's."""
    root = tmp_path / "csv"
    write_csv(root / "202504-tripdata_1.csv", [trip(i, f"2025-04-0{i + 1} 10:00:00") for i in range(3)])
    write_csv(root / "202505-tripdata_1.csv", [trip(7, "2025-04-30 23:50:00"), trip(8, "2025-05-01 00:10:00")])
    write_csv(root / "202506-tripdata_1.csv", [trip(9, "2025-06-02 08:00:00")])
    target = str(tmp_path / "trips")
    monthly.convert_months(spark, str(root), target)
    opened = lambda df: sorted({f.split("year=")[1].rsplit("/", 1)[0] for f in df.inputFiles()})
    april = trip_source.read_trips_parquet(spark, target, "2025-04-02", "2025-04-30", whole_end_day=True)
    assert sorted(r.ride_id for r in april.collect()) == ["r1", "r2", "r7"] and opened(april) == ["2025/month=4", "2025/month=5"]
    assert "PushedFilters: [IsNotNull(started_at)" in april._jdf.queryExecution().executedPlan().toString()
    june = trip_source.read_trips_parquet(spark, target, "2025-06-01")
    assert [(r.ride_id, r.year, r.month) for r in june.collect()] == [("r9", 2025, 6)] and opened(june) == ["2025/month=6"]
    assert trip_source.read_trips_parquet(spark, target, "2026-01-01").count() == 0
    # A file that the manifest doesn't know is read, and a month's entries follow its files.
    extra = june.withColumn("ride_id", F.lit("new")).withColumn("started_at", F.col("started_at") - F.expr("INTERVAL 40 DAY"))
    extra.drop("year", "month").write.mode("append").parquet(f"{target}/year=2025/month=6")
    again = trip_source.read_trips_parquet(spark, target, "2025-04-20", "2025-04-29")
    assert [r.ride_id for r in again.collect()] == ["new"]
    trip_source.write_manifest(spark, target, [(2025, 6)])
    known = spark.read.parquet(f"{target}/{trip_source.MANIFEST}").select("file", "month").distinct()
    assert {(r.month, r["count"]) for r in known.groupBy("month").count().collect()} == {(4, 1), (5, 1), (6, 2)}


def test_row_groups_and_files_are_bounded(spark, tmp_path):
    import pyarrow.parquet as pq

    pdf = random_trips(3, 950, ["A", "B"], 5)
    trips = as_trips(spark, pdf).coalesce(1).withColumns({"year": F.lit(2025), "month": F.lit(9)})
    trip_source.convert_to_parquet(trips, str(tmp_path / "t"), row_group_rows=100, file_rows=400)
    files = sorted((tmp_path / "t" / "year=2025" / "month=9").glob("*.parquet"))
    groups = [[pq.ParquetFile(f).metadata.row_group(i).num_rows for i in range(pq.ParquetFile(f).num_row_groups)] for f in files]
    assert sorted(map(sum, groups)) == [150, 400, 400] and max(n for g in groups for n in g) <= 100


def test_observed_audit_equals_a_second_count(spark, csv_root, tmp_path):
    target = str(tmp_path / "t")
    bad = tmp_path / "csv" / "202507-tripdata_1.csv"
    write_csv(bad, [trip(1, "2025-07-01 10:00:00"), trip(2, "not a time")])
    observed = monthly.convert_months(spark, str(tmp_path / "csv"), target)
    again = trip_source.conversion_audit(trip_source.read_monthly_csv(spark, str(tmp_path / "csv")), target)
    same = ["year", "month", "parts", "csv_rows", "parquet_rows", "csv_mb", "parquet_mb", "success"]
    assert observed.select(*same).collect() == again.select(*same).collect() and observed.first().unread_starts == 1


def test_csv_fallback_first_months_and_missing(spark, csv_root, tmp_path):
    rows = trip_source.read_trips(spark, str(csv_root), "2025-04-03", "2025-04-30").collect()
    assert [r.ride_id for r in rows] == ["r2"]
    whole_day = trip_source.read_trips_csv(spark, str(csv_root), "2025-04-03", "2025-04-30", whole_end_day=True)
    assert whole_day.count() == 2
    first = trip_source.read_monthly_csv(spark, str(csv_root), first_months=1)
    assert {r.month for r in first.select("month").distinct().collect()} == {4}
    with pytest.raises(FileNotFoundError):
        trip_source.read_trips(spark, str(tmp_path))


def test_export_and_summary(spark, tmp_path):
    pdf = random_trips(3, 200, ["A", "B"], 40)
    df = as_trips(spark, pdf).withColumn("month", F.month("started_at"))
    trip_source.export_parquet(df, str(tmp_path / "out"), ("month",))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
    trip_source.write_hourly_summary(query.hourly_od_summary(df), str(tmp_path / "summary"))
    assert spark.read.parquet(str(tmp_path / "summary")).agg(F.sum("trip_count")).first()[0] == 200


def test_station_sources(spark, tmp_path):
    fields = ["station_id", "short_name", "name", "capacity", "lat", "lng", "region_id", "station_type", "has_kiosk"]
    write_csv(tmp_path / "stations" / "station_info.csv", [dict(zip(fields, ["1", "s", "A", "x", "40", "-74", "71", "c", "true"]))], fields)
    path = str(tmp_path / "stations" / "station_info.csv")
    row = station_source.read_stations(spark, path).first()
    assert row.capacity is None and row.has_kiosk is True and row.lat == 40.0
    doc = {"last_updated": 1, "data": {"stations": [{"station_id": "1", "name": "A", "capacity": 5, "lat": 1, "lon": 2}, {"station_id": "2", "name": "B", "capacity": "9"}]}}
    (tmp_path / "feed.json").write_text(json.dumps(doc))
    rows = station_source.feed_stations(station_source.read_feed(spark, str(tmp_path / "feed.json")))
    both = station_source.union_regions({"nyc": rows.withColumn("name", F.lit("late")), "bkn": rows})
    kept = station_source.first_per_id(both).orderBy("station_id").collect()
    assert [(r.name, r.region, r.capacity, r.lng) for r in kept] == [("A", "bkn", 5.0, 2.0), ("B", "bkn", 9.0, None)]
    typed = station_source.typed_stations(rows)
    assert typed.columns == ["station_id", "name", "short_name", "lat", "capacity", "region_id"]
    station_source.write_stations(typed, str(tmp_path / "stations" / "station_info.parquet"))
    assert station_source.read_stations(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        station_source.read_stations(spark, str(tmp_path / "none.csv"))


def test_result_tables(spark, tmp_path):
    stat = {"mean": 1.5, "std": 0.5}
    for day, mae in (("20251210", 7.0), ("20251211", 6.0)):
        doc = {"model": "markov", "fold_results": [{"fold_id": 0, "inventory_mae": mae}], "summary": {"inventory_mae": {**stat, "mean": mae}}, "timestamp": day}
        (tmp_path / f"cv_results_markov_{day}.json").write_text(json.dumps(doc))
    latest = results.latest_documents(results.read_result_documents(spark, str(tmp_path)))
    assert results.document_summary(latest).collect() == [("markov", "inventory_mae", 6.0, 0.5)]
    assert results.document_folds(latest).first().inventory_mae == 6.0


def test_prepare(spark):
    rows = [("A", "B")] * 3 + [("B", "A")] * 2 + [("A", "C")] * 9 + [(None, "A"), ("B", None), ("D", "D")]
    pdf = pd.DataFrame(rows, columns=["start_station_name", "end_station_name"])
    pdf["started_at"] = pdf["ended_at"] = pd.Timestamp("2025-09-06 10:00:00")
    listed = spark.createDataFrame(
        [("2", "A", 99.0), ("1", "A", 20.0), ("3", "C", 7.0)], "station_id string, name string, capacity double"
    )
    kept, stats = prepare.prepare(as_trips(spark, pdf), listed, 5)
    # C is never a start, so it has no total; D has too few; B is not listed.
    assert {tuple(r) for r in stats.collect()} == {("A", 20.0), ("B", 20.0)}
    assert kept.count() == 5 and kept.first().is_weekend is True
    od = endpoints.od_by_hour(as_trips(spark, pdf))
    kept_od, stats_od = prepare.prepare_od(od, listed, 5)
    assert kept_od.agg(F.sum("trips")).first()[0] == 5
    assert {tuple(r) for r in stats_od.collect()} == {("A", 20.0), ("B", 20.0)}


def test_flow_from_od_equals_flow_of_trips(spark):
    trips = as_trips(spark, random_trips(1, 400, list("ABCD"), 5))
    a = endpoints.flow_by_bucket(trips).select("station_name", "bucket", "departures", "arrivals", "net")
    b = endpoints.flow_from_od(endpoints.od_by_hour(trips)).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_clamped_total_equals_loop(spark, seed):
    rng = np.random.RandomState(seed)
    rows = [(int(k), int(i), int(v)) for k in range(4) for i, v in enumerate(rng.randint(-6, 6, 50))]
    df = inventory.with_clamped_total(spark.createDataFrame(rows, "k int, i int, net int"), ["k"], "i", "net", 4.0)
    got = {(r.k, r.i): r.bikes for r in df.collect()}
    x = {}
    for k, i, v in rows:
        x[k] = max(0.0, x.get(k, 4.0) + v)
        assert got[k, i] == x[k]


def test_clamped_walk_of_a_year_of_minutes(spark):
    """One long walk and short ones, in blocks of few rows."""
    rng = np.random.RandomState(3)
    rows = spark.range(525_600).select(F.lit("long").alias("k"), F.col("id").alias("i"), (F.pmod(F.xxhash64("id"), F.lit(9)) - 4).alias("net"), F.lit(40.0).alias("cap"))
    short = [(f"s{k}", int(i), int(v), 6.0 + k) for k in range(3) for i, v in zip(sorted(rng.choice(5000, 40, replace=False)), rng.randint(-5, 6, 40))]
    df = rows.union(spark.createDataFrame(short, "k string, i long, net long, cap double"))
    out = inventory.with_clamped_walk(df, ["k"], "i", "net", 7.0, F.col("cap"), block=500)
    got = out.orderBy("k", "i").toPandas()
    want, x, last = [], 0.0, None
    for k, net, cap in df.orderBy("k", "i").select("k", "net", "cap").toPandas().itertuples(index=False):
        x = min(cap, max(0.0, (7.0 if k != last else x) + net))
        last = k
        want.append(x)
    assert np.array_equal(got["bikes"].to_numpy(), np.array(want)) and len(got) == 525_720


def test_month_inventory_equals_two_passes(spark):
    pdf = random_trips(9, 1500, list("ABCDE"), 75)
    listed = spark.createDataFrame([(s,) for s in "ABCDX"], "name string")
    out = inventory.month_inventory(as_trips(spark, pdf), listed)
    got = {(r.month, r.station_name): (r.start_bikes, r.end_bikes) for r in out.collect()}
    for month, part in pdf.groupby(pdf.started_at.dt.month):
        part = part[part.start_station_name.isin(list("ABCD")) & part.end_station_name.isin(list("ABCD"))]
        hours = sorted(part.started_at.unique())
        for s in "ABCD":
            end = start = 0
            for order, backward in ((hours, False), (reversed(hours), True)):
                x = 0
                for h in order:
                    now = part[part.started_at == h]
                    net = int((now.end_station_name == s).sum() - (now.start_station_name == s).sum())
                    x = max(0, x + (-net if backward else net))
                start, end = (x, end) if backward else (start, x)
            assert got[month, s] == (start, end)
    assert ("X" not in {k[1] for k in got}) and sum(v[0] for v in got.values()) == sum(v[1] for v in got.values())


@pytest.mark.parametrize("values", ["skewed", "few", "ties", "one"])
def test_exact_quantiles(spark, values):
    rng = np.random.RandomState(0)
    data = {
        "skewed": np.round(np.exp(rng.normal(0, 4, 5000)), 3),
        "few": np.array([3.0, 1.0, 2.0, 10.0]),
        "ties": rng.randint(0, 3, 999).astype(float),
        "one": np.array([5.0]),
    }[values]
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, F.col("v"), probs).collect()}
    assert np.allclose([got[p] for p in probs], np.quantile(data, probs))


def test_quantiles_narrow_by_rank(spark, monkeypatch):
    """One far outlier and close values, counted often and once: rounds follow the number of values."""
    close = spark.range(1_000_000).select((F.lit(1.0) + F.col("id") * 1e-9).alias("v"))
    df = close.union(spark.createDataFrame([(1e300,), (-1e300,)], "v double")).union(close.limit(1000))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.prob: r.quantile for r in exact_quantiles(df, F.col("v"), probs).collect()}
    values = np.concatenate([1.0 + np.arange(1_000_000) * 1e-9, [1e300, -1e300]])
    data = np.sort(np.concatenate([values, [r.v for r in close.limit(1000).collect()]]))
    assert all(got[p] == np.quantile(data, p) or abs(got[p] - np.quantile(data, p)) < 1e-15 for p in probs)
    hist = df.groupBy(F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("n")).persist()
    spans, rounds = quantiles.spans_of_ranks(hist, [0, 250_000, 900_000], few=200)
    assert 1 <= rounds <= 3 and all(s.distinct <= 200 and s.low <= s.high for s in spans.values())
    hist.unpersist()


def test_documents_of_the_latest_run(spark, tmp_path):
    metrics = [m for m in results.METRICS]
    rows = spark.createDataFrame([("markov", f, "2025-01-01", "2025-01-08", float(f)) for f in (1, 0)], "model string, fold_id int, train_start string, test_start string, v double")
    rows = rows.select("*", *[(F.col("v") + i).alias(m) for i, m in enumerate(metrics)])
    summary = spark.createDataFrame([("markov", m, 0.5 + i, 0.5) for i, m in enumerate(metrics)], "model string, metric string, mean double, std double")
    for run, kept in (("20250101", rows.where("fold_id = 0")), ("20250102", rows)):
        results.write_documents(kept, summary, str(tmp_path), run, 7)
    latest = results.latest_documents(results.read_result_documents(spark, f"{tmp_path}/*"))
    assert latest.count() == 1 and latest.first().timestamp == "20250102" and latest.first().random_seed == 7
    assert [r.fold_id for r in results.document_folds(latest).collect()] == [0, 1]
    assert {(r.metric, r.mean, r.std) for r in results.document_summary(latest).collect()} == {(m, 0.5 + i, 0.5) for i, m in enumerate(metrics)}


def test_network_summary_reads_the_trips_twice(spark, tmp_path, monkeypatch):
    trips = as_trips(spark, random_trips(2, 300, list("ABC"), 9)).withColumns({"rideable_type": F.lit("x"), "member_casual": F.when(F.hour("started_at") < 9, "m")})
    trips.write.parquet(str(tmp_path / "t"))
    read, written = spark.read.parquet(str(tmp_path / "t")), []

    def counted(df):
        written.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return cut(df)

    monkeypatch.setattr(quality, "cut", counted)
    monkeypatch.setattr(quantiles, "cut", counted)
    row = quality.network_summary(read, ["x", "y"], ["m"])
    assert "FileScan" not in physical(row) and written == [1, 1]
    r = row.first()
    assert (r.total_trips, r.n_stations, r.share_x, r.share_y, r.share_m) == (300, 3, 1.0, 0.0, 1.0) and r.sparsity == 1 - r.n_routes / 9
    none = quality.network_summary(read.where("false"), ["x"], ["m"]).first()
    assert (none.total_trips, none.n_stations, none.n_routes, none.median_minutes) == (0, 0, 0, None)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    as_trips(spark, random_trips(1, 50, list("AB"), 3)).withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "t"))
    trips = spark.read.parquet(str(tmp_path / "t"))
    plan = physical(endpoints.station_activity(trips))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "ended_at" not in plan and "extra" not in plan
    found = physical(trips.where(name_contains("start_station_name", "A")))
    assert "StringContains(start_station_name,A)" in found
    for df in (endpoints.trips_by_station(trips), query.hourly_od_summary(trips), exact_quantiles(trips, F.hour("started_at"), [0.5])):
        assert "CartesianProduct" not in physical(df) and "NestedLoop" not in physical(df)


def test_filters_and_labels(spark):
    df = spark.createDataFrame([("a_b", 1), ("axb", 2), (None, 3)], "s string, n int")
    assert [r.n for r in df.where(name_contains("s", "a_")).collect()] == [1]
    assert query.select_where(df, ["n"], {"s": None}).collect() == [(3,)]
    assert query.select_where(df, limit=0).count() == 3
    names = spark.createDataFrame([("x" * 40,), ("y" * 41,)], "s string").select(short_label("s")).collect()
    assert [r[0] for r in names] == ["x" * 40, "y" * 37 + "..."]


def test_capacity_zero_and_negative_durations(spark):
    trips = spark.createDataFrame([("s1", "A", 2025, 6)] * 3, "start_station_id string, start_station_name string, year int, month int")
    docks = spark.createDataFrame([("s1", 0.0)], "station_id string, capacity double")
    assert stations.trips_per_capacity(trips, docks, 2025, 6).collect() == [("A", 0.0, 3, None)]
    pdf = random_trips(1, 4, ["A"], 1)
    pdf.loc[0, "ended_at"] = pdf.loc[0, "started_at"] - pd.Timedelta(minutes=1)
    pdf.loc[1, "ended_at"] = pdf.loc[1, "started_at"]
    pdf.loc[2, "ended_at"] = pdf.loc[2, "started_at"] + pd.Timedelta(days=2)
    assert tuple(quality.duration_anomalies(as_trips(spark, pdf)).first()) == (1, 1, 1, 1, 1)


def test_constant_configurations_score_half(spark):
    rows = [(c, m, v, 0.2) for c, v in ((1, 4.0), (2, 2.0)) for m in ("inventory_mae",)] + [(c, "full_recall", 0.5, 0.1) for c in (1, 2)]
    summary = spark.createDataFrame(rows, "config_id int, metric string, mean double, std double")
    got = {(r.config_id, r.metric): (r.score, r.score_std) for r in compare.normalized_configs(summary).collect()}
    assert got[1, "inventory_mae"] == (0.0, 0.1) and got[2, "inventory_mae"] == (1.0, 0.1)
    assert got[1, "full_recall"] == (0.5, 0.0)


def test_month_inventory_files(spark, tmp_path):
    trips = as_trips(spark, random_trips(4, 300, list("AB"), 40))
    inferred, summary = monthly.infer_months(trips, None, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "month_inventory")).count() == inferred.count() == 4
    start = spark.read.option("header", True).csv(str(tmp_path / "start_inventory"))
    assert start.columns == ["station_name", "bikes", "year", "month"] and start.count() == 4
    assert spark.read.json(str(tmp_path / "inventory_summary")).count() == summary.count() == 2
