"""The registered queries: every operator over the bundled tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.text import name_contains, short_label
from dockflow.functions.time import duration_minutes, started_between
from dockflow.operators import compare, endpoints, ensemble, evaluate, flow_models, folds, inventory, markov
from dockflow.operators import prepare, quality, query, routes, stations, temporal
from dockflow.plans import cross_validation as cv
from dockflow.plans import lookback, monthly
from dockflow.session import cut, resident, scratch_path, union_all
from dockflow.sources import bundled as tables
from dockflow.sources import results
from dockflow.sources import stations as station_source
from dockflow.sources import trips as trip_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The threshold of the operators' own queries; the two queries about the threshold
# itself use one that leaves stations out.
MIN_TRIPS, SELECTIVE_MIN_TRIPS = 100, 780
FLOW_MODELS = ("persistence", "station_avg", "temporal_flow")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since sums differ in their last digits with the order
    of addition, and dates as text."""

    def shown(c: str, kind: str):
        if kind == "double":
            return (F.round(c, digits) + F.lit(0.0)).alias(c)
        return F.col(c).cast("string").alias(c) if kind == "date" else F.col(c)

    return df.select(*[shown(c, kind) for c, kind in df.dtypes])


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
    return fn


def on_trips(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(build(tables.event_trips(spark, sf_dir)))


def on_lineitem(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(build(tables.lineitem_trips(spark, sf_dir)))


# -- exploration --------------------------------------------------------------

on_trips("station_net_flow", endpoints.net_flow_ranking)
on_trips("station_activity", endpoints.station_activity)
on_trips("station_names", endpoints.station_names)
on_trips("trip_stats", query.trip_stats)
on_trips("trips_by_station", endpoints.trips_by_station)
on_trips(
    "aggregate_trips",
    lambda t: query.aggregate_trips(
        t,
        ["start_station_name", "rideable_type"],
        {"trip_count": "count(*)", "riders": "count(DISTINCT member_casual)", "last_start": "max(started_at)"},
        {"member_casual": "member"},
    ),
)
on_trips(
    "query_filter_limit",
    lambda t: query.select_where(
        t, ["ride_id", "started_at", "end_station_name"], {"start_station_name": None, "member_casual": "casual"}, 25,
        order=["started_at", "ride_id"],
    ),
)
on_trips("date_range_trips", lambda t: t.where(started_between("2024-01-05", "2024-01-12")).select("ride_id", "started_at"))
on_trips("station_search", lambda t: t.where(name_contains("start_station_name", "_1")).select("ride_id", "start_station_name"))
on_trips("trips_by_hour", temporal.trips_by_hour)
on_trips("trips_by_day", temporal.trips_by_day)
on_trips("trips_by_date", temporal.trips_by_date)
on_trips("weekday_weekend_hourly", temporal.hourly_by_day_type)
on_trips("hour_dow_matrix", temporal.hour_day_matrix)
on_trips("type_shares", lambda t: temporal.type_shares(t, "rideable_type", "member_casual"))
on_trips("user_type_hourly", temporal.user_type_hourly)
on_trips("user_type_daily", temporal.user_type_daily)
on_trips("daily_count_describe", temporal.daily_count_description)
on_trips("station_hourly", lambda t: temporal.station_hourly(t, "NATION_7"))
on_trips("trips_per_month", temporal.trips_per_month)
on_trips("missing_months", lambda t: temporal.missing_months(t, "2023-10-01", "2024-04-01"))
on_trips("od_counts", routes.od_counts)
on_trips("top_routes", lambda t: routes.top_routes(routes.od_counts(t)))
on_trips("self_loops", lambda t: routes.self_loops(routes.od_counts(t)))
on_trips("route_count_describe", lambda t: routes.describe_route_counts(routes.od_counts(t)))
on_trips("route_pareto", lambda t: routes.route_pareto(routes.od_counts(t)))
on_trips("route_cumulative_share", lambda t: routes.route_cumulative_share(routes.od_counts(t)))
on_trips("route_cdf", lambda t: routes.route_cdf(routes.od_counts(t)))
on_trips("route_diversity", lambda t: routes.route_diversity(routes.od_counts(t)))
on_trips("sparsity", routes.sparsity)
on_trips("transition_shares", lambda t: routes.transition_probabilities(routes.od_counts(t)))
on_trips("topn_transition_probs", lambda t: routes.top_station_probabilities(t, 10))
on_trips("busiest_stations", lambda t: stations.busiest(endpoints.station_activity(t)))
on_trips(
    "receivers_senders",
    lambda t: union_all(
        stations.receivers(endpoints.station_activity(t)).withColumn("side", F.lit("receiver")),
        stations.senders(endpoints.station_activity(t)).withColumn("side", F.lit("sender")),
    ),
)
on_trips("multi_id_stations", stations.multi_id_stations)
on_trips("station_coords", stations.station_coords)
on_trips("station_locations", stations.station_locations)
on_trips("net_flow_q95", lambda t: stations.net_flow_quantile(endpoints.station_activity(t)))
on_trips(
    "null_census",
    lambda t: quality.null_census(
        t, ["ride_id", "started_at", "start_station_name", "start_station_id", "end_station_name", "end_station_id", "end_lat"]
    ),
)
on_trips("duration_describe", quality.describe_durations)
on_trips("duration_anomalies", quality.duration_anomalies)
on_trips(
    "plausible_durations",
    lambda t: quality.plausible_durations(t).groupBy("rideable_type").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("duration_min").alias("mean_minutes")
    ),
)
on_trips("network_summary", lambda t: quality.network_summary(t, ["click", "view"], ["member", "casual"]))
on_trips("hourly_od_summary", query.hourly_od_summary)
on_trips("od_by_hour", endpoints.od_by_hour)
on_trips("flow_by_hour", endpoints.flow_by_bucket)
on_trips("flow_by_quarter_hour", lambda t: endpoints.flow_by_bucket(t, 900))


@registered
def trips_per_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, docks = tables.event_trips(spark, sf_dir), tables.nation_stations(spark, sf_dir)
    return stations.trips_per_capacity(trips, docks, 2024, 1)


# Longer, wider input: as many stations as suppliers over seven years.
on_lineitem("supplier_net_flow", lambda t: endpoints.net_flow_ranking(t, 50))
on_lineitem("supplier_od_pareto", lambda t: routes.route_pareto(routes.od_counts(t)))
on_lineitem("supplier_od_describe", lambda t: routes.describe_route_counts(routes.od_counts(t)))
on_lineitem("supplier_top_probs", lambda t: routes.top_station_probabilities(t, 30))
on_lineitem("supplier_durations", quality.describe_durations)
on_lineitem("supplier_months", temporal.trips_per_month)
on_lineitem("supplier_missing_months", lambda t: temporal.missing_months(t, "1994-11-01", "2002-02-01"))


# -- sources ------------------------------------------------------------------


@registered
def unified_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly sources with different columns behind one view."""
    events = tables.event_trips(spark, sf_dir).drop("year", "month")
    items = tables.lineitem_trips(spark, sf_dir).drop("year", "month")
    view = trip_source.unified_view(spark, {(2024, 1): events, (2001, 11): items}, "all_trips")
    return view.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("start_station_id").alias("with_station_id"),
        F.count("start_station_name").alias("with_station_name"),
        F.min("started_at").alias("first_start"),
    )


@registered
def feed_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = station_source.parse_feed(tables.supplier_feed(spark, sf_dir))
    return station_source.feed_stations(feed).drop("c", "position")


@registered
def feed_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_source.feed_stations(station_source.parse_feed(tables.supplier_feed(spark, sf_dir)))
    first = station_source.first_per_id(rows)
    return station_source.typed_stations(first, ["station_id", "name", "short_name", "lat", "lng", "capacity", "region_id", "region"])


@registered
def station_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_source.feed_stations(station_source.parse_feed(tables.supplier_feed(spark, sf_dir)))
    return station_source.station_summary(station_source.first_per_id(rows))


@registered
def stations_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_source.feed_stations(station_source.parse_feed(tables.supplier_feed(spark, sf_dir)))
    return station_source.stations_per_region(station_source.first_per_id(rows))


@registered
def station_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels cut to length; joined names give some that are too long."""
    suppliers = tables.table(spark, sf_dir, "supplier").join(
        tables.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    name = F.concat_ws(" & ", "s_name", "n_name", F.repeat(F.lit("x"), (F.col("s_suppkey") % 17).cast("int")))
    return suppliers.select("s_suppkey", short_label(name).alias("label"))


@registered
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly CSV parts converted to partitioned Parquet and read back over a
    date range; the files go to the session's shared folder."""
    trips = tables.lineitem_trips(spark, sf_dir)
    folder = scratch_path(spark, "csv-parts")
    stamp = F.concat(F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("-tripdata"))
    columns = [f.name for f in trip_source.TRIPS.fields]
    whole = trips.select(
        *[F.col(c) if c in trips.columns else F.lit(None).cast("string").alias(c) for c in columns], stamp.alias("part")
    )
    whole.hint("rebalance", "part").write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).partitionBy("part").csv(folder)
    target = scratch_path(spark, "trips-parquet")
    audit = monthly.convert_months(spark, folder, target)
    back = trip_source.read_trips_parquet(spark, target, "1995-03-15", "2001-06-30")
    read = back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("read_rows"), F.max("started_at").alias("last_start"), F.sum(duration_minutes()).alias("minutes")
    )
    whole = audit.select("year", "month", "csv_rows", "parquet_rows", "success")
    return whole.join(read, ["year", "month"], "left").fillna(0, ["read_rows", "minutes"])


def _csv_parts(trips: DataFrame, folder: str) -> None:
    """Trips as monthly CSV parts of two column orders, the casual riders' apart."""
    columns = [f.name for f in trip_source.TRIPS.fields]
    whole = trips.select(*[F.col(c) if c in trips.columns else F.lit(None).cast("string").alias(c) for c in columns], "year", "month")
    stamp = F.concat(F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("-tripdata"))
    casual = F.col("member_casual") == "casual"
    for rows, order in ((whole.where(casual), columns[::-1]), (whole.where(~casual), columns)):
        parts = rows.select(*order, stamp.alias("part")).hint("rebalance", "part").write.mode("append")
        parts.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").partitionBy("part").csv(folder)


def _read_back(trips: DataFrame) -> DataFrame:
    return trips.groupBy("member_casual", "start_station_name").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("started_at").alias("first_start"),
        F.sum(duration_minutes()).alias("minutes"),
        F.count_distinct("end_station_id").alias("end_ids"),
    )


@registered
def csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range of trips out of CSV parts whose columns come in two orders."""
    folder = scratch_path(spark, "csv-trips")
    _csv_parts(tables.event_trips(spark, sf_dir), folder)
    return _read_back(trip_source.read_trips_csv(spark, folder, "2024-01-04", "2024-01-25", whole_end_day=True, glob="*.csv"))


@registered
def chosen_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data folder read before and after its CSV parts have become Parquet;
    only the Parquet has the riders that were left out of the CSV."""
    folder = scratch_path(spark, "data")
    trips = tables.event_trips(spark, sf_dir)
    _csv_parts(trips.where(F.col("member_casual") == "casual"), f"{folder}/202401-csv")
    before = cut(_read_back(trip_source.read_trips(spark, folder, "2024-01-04", "2024-01-25", glob="*.csv")))
    trip_source.convert_to_parquet(trips, f"{folder}/parquet/trips")
    after = _read_back(trip_source.read_trips(spark, folder, "2024-01-04", "2024-01-25"))
    forced = _read_back(trip_source.read_trips(spark, folder, "2024-01-04", "2024-01-25", use_parquet=False, glob="*.csv"))
    named = {"before": before, "parquet": after, "csv": forced}
    return union_all(*[rows.withColumn("source", F.lit(name)) for name, rows in named.items()])


@registered
def conversion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the audit that the conversion itself observes."""
    folder = scratch_path(spark, "csv-parts")
    _csv_parts(tables.event_trips(spark, sf_dir), folder)
    audit = monthly.convert_months(spark, folder, scratch_path(spark, "trips-parquet"))
    totals = trip_source.audit_totals(audit).select("successful", "failed", "total_rows")
    return totals.withColumn("unread_starts", audit.agg(F.sum("unread_starts")).scalar())


@registered
def station_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station dimension from its CSV, and from the Parquet that then stands beside it."""
    folder = scratch_path(spark, "stations")
    docks = tables.nation_stations(spark, sf_dir)
    capacity = F.when(F.col("capacity") > 0, F.col("capacity").cast("string")).otherwise(F.lit("none"))
    columns = [F.col(f.name) if f.name in docks.columns else F.lit(None).cast("string").alias(f.name) for f in station_source.STATIONS.fields]
    docks.withColumn("capacity", capacity).select(*columns).write.option("header", True).csv(f"{folder}/info.csv")
    from_csv = cut(station_source.read_stations(spark, f"{folder}/info.csv"))
    kept = station_source.typed_stations(from_csv.where("capacity IS NOT NULL"), ["station_id", "name", "capacity", "lat", "lng", "region_id"])
    station_source.write_stations(kept, f"{folder}/info.parquet")
    from_parquet = station_source.read_stations(spark, f"{folder}/info.csv")
    return union_all(
        from_csv.select(*kept.columns).withColumn("source", F.lit("csv")), from_parquet.withColumn("source", F.lit("parquet"))
    )


@registered
def exported_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned export, read back by partition."""
    path = scratch_path(spark, "export")
    trips = tables.event_trips(spark, sf_dir).withColumn("day", F.to_date("started_at"))
    trip_source.export_parquet(trips.select("ride_id", "started_at", "start_station_name", "member_casual", "day"), path, ("member_casual", "day"))
    return spark.read.parquet(path).groupBy("member_casual", F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("trips"), F.count("start_station_name").alias("named"), F.max("started_at").alias("last_start")
    )


@registered
def stored_hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hourly")
    trip_source.write_hourly_summary(query.hourly_od_summary(tables.event_trips(spark, sf_dir)), path)
    return spark.read.parquet(path)


@registered
def month_inventory_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred inventories out of their JSON and CSV files, a folder for each month."""
    path = scratch_path(spark, "inventories")
    monthly.infer_months(tables.event_trips(spark, sf_dir), tables.nation_stations(spark, sf_dir), path)
    documents = spark.read.json(f"{path}/month_documents").select("year", "month", F.inline("stations")).drop("end_bikes")
    ends = spark.read.option("header", True).csv(f"{path}/end_inventory").select(
        F.col("year").cast("long"), F.col("month").cast("long"), "station_name", F.col("bikes").cast("long").alias("end_bikes")
    )
    return documents.join(ends, ["year", "month", "station_name"]).select("year", "month", "station_name", "start_bikes", "end_bikes")


@registered
def top_start_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's stations with most bikes at its start."""
    months = inventory.month_inventory(tables.lineitem_trips(spark, sf_dir), tables.supplier_stations(spark, sf_dir))
    return inventory.top_start_inventory(months)


# -- preparation, folds, inventories -------------------------------------------


def _data(spark: SparkSession, sf_dir: str) -> cv.Prepared:
    return cv.prepared(tables.event_trips(spark, sf_dir), tables.nation_stations(spark, sf_dir), MIN_TRIPS)


def _folds(data: cv.Prepared, train: int = 2, test: int = 1, step: int = 1) -> cv.Folded:
    return cv.folded(data, cv.folds_of(data, train, test, step))


@registered
def prepared_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = prepare.prepare(tables.event_trips(spark, sf_dir), tables.nation_stations(spark, sf_dir), SELECTIVE_MIN_TRIPS)
    return kept.select("ride_id", "start_station_name", "end_station_name", "hour", "day_of_week", "date", "is_weekend")


@registered
def station_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = prepare.valid_stations(tables.event_trips(spark, sf_dir), SELECTIVE_MIN_TRIPS)
    return prepare.station_stats(valid, tables.nation_stations(spark, sf_dir))


@registered
def month_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.month_inventory(tables.event_trips(spark, sf_dir), tables.nation_stations(spark, sf_dir))


@registered
def month_inventory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = tables.event_trips(spark, sf_dir)
    return monthly.infer_months(trips, tables.nation_stations(spark, sf_dir))[1]


@registered
def supplier_month_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """84 months in one job."""
    return inventory.month_inventory(tables.lineitem_trips(spark, sf_dir), tables.supplier_stations(spark, sf_dir))


@registered
def running_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-clamped running total per station from five bikes."""
    hourly = endpoints.flow_by_bucket(tables.event_trips(spark, sf_dir))
    return inventory.with_clamped_total(hourly, ["station_name"], "bucket", "net", 5.0).select("station_name", "bucket", "bikes")


@registered
def clamped_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of hours between empty and full, as a walk in blocks."""
    hourly = endpoints.flow_by_bucket(tables.lineitem_trips(spark, sf_dir))
    hour = F.timestamp_diff("HOUR", F.lit("1990-01-01").cast("timestamp_ntz"), F.col("bucket"))
    full = F.length("station_name") + 1
    walk = inventory.with_clamped_walk(hourly.withColumn("hour", hour), ["station_name"], "hour", "net", 3.5, full)
    return walk.select("station_name", "hour", "net", "bikes")


@registered
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.rolling_folds(tables.event_trips(spark, sf_dir), 2, 1, 1)


@registered
def cv_folds_default_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.rolling_folds(tables.lineitem_trips(spark, sf_dir), 3, 1)


@registered
def fold_trip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    return folds.fold_trip_counts(data.od, cv.folds_of(data, 2, 1, 1))


@registered
def fold_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    return folds.fold_facts(cv.folds_of(data, 2, 1, 1), data.flows)


@registered
def initial_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folds(_data(spark, sf_dir)).init.select("fold_id", "station_name", "capacity", "bikes")


@registered
def tracked_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.to_long(_folds(_data(spark, sf_dir)).truth).drop("capacity")


# -- forecasts ----------------------------------------------------------------


@registered
def fit_station_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    params = flow_models.fit_station_avg(data.flows, _folds(data).folds)
    return params.join(F.broadcast(flow_models.mean_flow(params)), "fold_id")


@registered
def fit_temporal_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    params = flow_models.fit_temporal_flow(data.flows, _folds(data).folds)
    return params.join(F.broadcast(flow_models.mean_flow(params)), "fold_id")


@registered
def flow_model_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted keys and mean flow when everything is training data."""
    data = _data(spark, sf_dir)
    whole = resident(cv.fit_everything(data))
    by_station = flow_models.station_avg_report(flow_models.fit_station_avg(data.flows, whole))
    by_context = flow_models.temporal_flow_report(flow_models.fit_temporal_flow(data.flows, whole))
    report = lambda df, model, n: df.select(F.lit(model).alias("model"), F.col(n).alias("n_params"), "global_avg_flow")
    return union_all(
        report(by_station, "station_avg", "n_stations"), report(by_context, "temporal_flow", "n_flow_combinations")
    )


def _forecast_query(model: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = _data(spark, sf_dir)
        return inventory.to_long(cv.forecast(model, data, _folds(data), 168)).drop("capacity")

    run.__name__ = f"forecast_{model}"
    registered(run)


for _model in FLOW_MODELS:
    _forecast_query(_model)


@registered
def forecast_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    paths = inventory.to_long(cv.forecast("station_avg", data, _folds(data), 168))
    states = flow_models.forecast_states(paths, 0.1, 0.9)
    return states.groupBy("fold_id", "station_name", "state").agg(F.count(F.lit(1)).alias("hours"))


@registered
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    return cv.cross_validate(data, FLOW_MODELS, cv.folds_of(data, 2, 1, 1))


@registered
def state_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    fold = _folds(data)
    pairs = evaluate.align(inventory.to_long(fold.truth), inventory.to_long(cv.forecast("persistence", data, fold, 168)))
    return evaluate.confusion(pairs)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.summarize_folds(fold_metrics(spark, sf_dir), "model")


QUERIES["cv_summary"] = lambda spark, sf_dir: rounded(_summary(spark, sf_dir))


@registered
def supplier_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of folds that leave no week out, over all suppliers."""
    data = cv.prepared(tables.lineitem_trips(spark, sf_dir), tables.supplier_stations(spark, sf_dir), 100)
    return cv.cross_validate(data, ("persistence", "temporal_flow"), cv.folds_of(data, 8, 1, 63))


# -- Markov -------------------------------------------------------------------

MIN_TRANSITIONS = 6


def _fit(spark: SparkSession, sf_dir: str) -> tuple[cv.Prepared, DataFrame, markov.MarkovFit]:
    data = _data(spark, sf_dir)
    facts = cv.facts_of(data, cv.folds_of(data, 1, 1, 7))
    return data, facts, markov.fit_markov(data.od, facts, MIN_TRANSITIONS)


def _station_count(data: cv.Prepared):
    return data.stations.agg(F.count(F.lit(1))).scalar()


@registered
def transition_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.effective_edges(_fit(spark, sf_dir)[2])


@registered
def departure_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.departure_rates(_fit(spark, sf_dir)[2].edges)


@registered
def global_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit(spark, sf_dir)[2].fallback


@registered
def markov_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit(spark, sf_dir)[2].contexts


@registered
def context_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.transitions_of(_fit(spark, sf_dir)[2], 8, False)


@registered
def top_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.top_destinations(markov.effective_edges(_fit(spark, sf_dir)[2]), 3)


@registered
def top_rate_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.busiest_stations(markov.departure_rates(_fit(spark, sf_dir)[2].edges), 5)


@registered
def route_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _fit(spark, sf_dir)[2].edges
    return markov.route_volumes(edges, markov.busiest_stations(markov.departure_rates(edges), 7).drop("rank"))


@registered
def busy_submatrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _fit(spark, sf_dir)[2].edges
    return markov.busy_submatrix(edges, markov.busiest_stations(markov.departure_rates(edges), 7))


@registered
def residential_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.residential_stations(markov.departure_rates(markov.effective_edges(_fit(spark, sf_dir)[2])))


@registered
def hourly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.hourly_activity(markov.departure_rates(_fit(spark, sf_dir)[2].edges))


@registered
def context_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, fit = _fit(spark, sf_dir)
    return markov.context_statistics(fit.edges, markov.departure_rates(fit.edges), _station_count(data))


@registered
def markov_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, fit = _fit(spark, sf_dir)
    return markov.markov_report(fit, _station_count(data))


@registered
def net_flow_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, facts, fit = _fit(spark, sf_dir)
    return markov.forecast_net_flow(markov.effective_edges(fit), data.stations, facts)


@registered
def forecast_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of each test window."""
    data, facts, fit = _fit(spark, sf_dir)
    init = cut(inventory.initial_inventory(data.flows, data.stations, facts))
    paths = markov.forecast_markov(fit, init, 168)
    return inventory.to_long(paths).drop("capacity")


@registered
def forecast_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and bounds of 50 simulations of each test window."""
    data, facts, fit = _fit(spark, sf_dir)
    init = cut(inventory.initial_inventory(data.flows, data.stations, facts))
    return ensemble.forecast_with_uncertainty(fit, init, 168, 50)


# -- comparison ---------------------------------------------------------------


@registered
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_models(_summary(spark, sf_dir), "temporal_flow", "persistence")


@registered
def compare_improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.improvements(compare.compare_models(_summary(spark, sf_dir), "temporal_flow", "persistence"))


@registered
def compare_models_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_models_pct(_summary(spark, sf_dir), "station_avg", "temporal_flow")


@registered
def compare_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    pct = compare.compare_models_pct(_summary(spark, sf_dir), "station_avg", "temporal_flow")
    return compare.wins(pct, "station_avg", "temporal_flow")


@registered
def model_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.advantage(_summary(spark, sf_dir), "station_avg", "temporal_flow")


@registered
def fold_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.fold_series(fold_metrics(spark, sf_dir), "station_avg", "temporal_flow")


@registered
def latest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored runs of each model; the later one is read back."""
    path = scratch_path(spark, "cv-results")
    metrics = cut(fold_metrics(spark, sf_dir))
    results.append_results(results.stamped(metrics.where(F.col("fold_id") < 3), "20240101_000000"), path)
    results.append_results(results.stamped(metrics, "20240102_000000"), path)
    latest = results.latest_per_model(spark.read.parquet(path))
    return latest.select("model", "run_ts", "fold_id", "inventory_mae", "state_accuracy")


@registered
def result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result documents of two runs; of each model the later one's folds are read back."""
    path = scratch_path(spark, "documents")
    metrics = cut(fold_metrics(spark, sf_dir))
    for run, kept in (("20240101_000000", F.col("fold_id") < 2), ("20240102_000000", F.lit(True))):
        rows = metrics.where(kept)
        results.write_documents(rows, evaluate.summarize_folds(rows, "model"), path, run, 42)
    latest = results.latest_documents(results.read_result_documents(spark, f"{path}/*"))
    return results.document_folds(latest).select("model", "fold_id", "inventory_mae", "full_recall", "train_start", "test_start")


@registered
def stored_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary rows with their configuration, through a table and through documents."""
    table, path = scratch_path(spark, "summary"), scratch_path(spark, "documents")
    metrics = cut(fold_metrics(spark, sf_dir))
    summary = cut(evaluate.summarize_folds(metrics, "model"))
    results.append_results(results.stamped(summary, "20240102_000000", "2 weeks", 42), table)
    results.write_documents(metrics, summary, path, "20240102_000000", 42)
    rows = results.latest_per_model(spark.read.parquet(table)).select("model", "metric", "mean", "std", "config", "random_seed", "run_ts")
    documents = results.document_summary(results.read_result_documents(spark, f"{path}/*"))
    other = documents.select("model", "metric", F.col("mean").alias("document_mean"), F.col("std").alias("document_std"))
    return rows.join(other, ["model", "metric"], "left")


@registered
def lookback_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Markov model over the three training windows, all folds in one walk."""
    data = _data(spark, sf_dir)
    return lookback.lookback_sweep(data, min_transitions=MIN_TRANSITIONS)


@registered
def normalized_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = lookback.lookback_sweep(_data(spark, sf_dir), model="temporal_flow")
    return lookback.sweep_scores(metrics)


@registered
def recommend_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = lookback.lookback_sweep(_data(spark, sf_dir), model="temporal_flow")
    return lookback.sweep_recommendation(metrics, lookback.configurations(spark))


@registered
def recommend_test_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One and two weeks of training against one and two weeks of test."""
    metrics = lookback.lookback_sweep(_data(spark, sf_dir), lookback.TEST_LENGTHS, model="temporal_flow")
    return lookback.sweep_recommendation(metrics, lookback.configurations(spark, lookback.TEST_LENGTHS))
