"""DuckDB SQL for the registered queries, written without reference to how the
Spark side computes them: plain joins and counts, running loops as recursive
queries, every fold by its own range conditions."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TRIPS = """trips AS (
    SELECT CAST(e.event_id AS VARCHAR) AS ride_id, e.event_type AS rideable_type, e.ts AS started_at,
        e.ts + to_seconds(CAST(round(e.value * 60) AS BIGINT)) AS ended_at,
        a.n_name AS start_station_name,
        'S' || CAST(a.n_nationkey AS VARCHAR) || '-' || CAST(e.k % 2 AS VARCHAR) AS start_station_id,
        b.n_name AS end_station_name,
        'S' || CAST(b.n_nationkey AS VARCHAR) || '-' || CAST(e.user_id % 2 AS VARCHAR) AS end_station_id,
        CASE WHEN e.k = 99 THEN 0::DOUBLE ELSE 40.45::DOUBLE + a.n_nationkey * 0.02::DOUBLE END AS start_lat,
        -74.2::DOUBLE + a.n_nationkey * 0.02::DOUBLE AS start_lng,
        CASE WHEN e.k = 99 THEN 0::DOUBLE ELSE 40.45::DOUBLE + b.n_nationkey * 0.02::DOUBLE END AS end_lat,
        -74.2::DOUBLE + b.n_nationkey * 0.02::DOUBLE AS end_lng,
        CASE WHEN e.user_id % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual,
        CAST(year(e.ts) AS INTEGER) AS year, CAST(month(e.ts) AS INTEGER) AS month
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
    LEFT JOIN nation a ON a.n_nationkey = e.user_id % 26
    LEFT JOIN nation b ON b.n_nationkey = e.k % 26)"""

DOCKS = """docks AS (
    SELECT 'S' || CAST(n_nationkey AS VARCHAR) || '-0' AS station_id, n_name AS name,
        CASE WHEN n_nationkey = 3 THEN 0::DOUBLE ELSE CAST(10 + (n_nationkey * 7) % 31 AS DOUBLE) END AS capacity
    FROM nation WHERE n_nationkey <> 5)"""

ITEMS = """trips AS (
    SELECT l_returnflag AS rideable_type,
        l_shipdate + to_hours(CAST(l_quantity AS BIGINT) % 24) AS started_at,
        l_shipdate + to_hours(CAST(l_quantity AS BIGINT) % 24) + to_minutes(l_linenumber * 7) AS ended_at,
        'Supplier ' || CAST(l_suppkey AS VARCHAR) AS start_station_name,
        'Supplier ' || CAST(l_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS end_station_name,
        CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
    FROM lineitem)"""
ITEM_DOCKS = """docks AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS station_id, 'Supplier ' || CAST(s_suppkey AS VARCHAR) AS name,
        CAST(s_suppkey % 31 + 10 AS DOUBLE) AS capacity FROM supplier)"""

MINUTES = "(epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0::DOUBLE"
WEEKEND = "(dayofweek({0}) IN (0, 6))"


def r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 6) + 0.0::DOUBLE AS {name or expr}"


def trip_sql(name: str, sql: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",\n".join([TRIPS, *ctes]) + "\n" + sql


def item_sql(name: str, sql: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",\n".join([ITEMS, *ctes]) + "\n" + sql


SIDES = """dep AS (SELECT start_station_name AS station_name, count(*) AS n FROM trips GROUP BY 1),
arr AS (SELECT end_station_name AS station_name, count(*) AS n FROM trips GROUP BY 1)"""
ACTIVITY = (
    SIDES
    + """,
activity AS (SELECT coalesce(d.station_name, a.station_name) AS station_name, coalesce(d.n, 0) AS departures,
        coalesce(a.n, 0) AS arrivals, coalesce(d.n, 0) + coalesce(a.n, 0) AS total_trips,
        coalesce(a.n, 0) - coalesce(d.n, 0) AS net_flow
    FROM (SELECT * FROM dep WHERE station_name IS NOT NULL) d
    FULL OUTER JOIN (SELECT * FROM arr WHERE station_name IS NOT NULL) a ON d.station_name = a.station_name)"""
)
OD = """od AS (SELECT start_station_name, end_station_name, count(*) AS count FROM trips
    WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL GROUP BY 1, 2)"""

RANKING = """SELECT station_name, departures, arrivals, net_flow FROM activity
    ORDER BY abs(net_flow) DESC, station_name LIMIT {n}"""
trip_sql("station_net_flow", RANKING.format(n=20), ACTIVITY)
item_sql("supplier_net_flow", RANKING.format(n=50), ACTIVITY)
trip_sql("station_activity", "SELECT * FROM activity", ACTIVITY)
trip_sql("station_names", "SELECT start_station_name AS station_name FROM trips WHERE start_station_name IS NOT NULL UNION SELECT end_station_name FROM trips WHERE end_station_name IS NOT NULL")
trip_sql(
    "trip_stats",
    f"""SELECT count(*) AS total_trips, count(DISTINCT start_station_name) AS n_start_stations,
    count(DISTINCT end_station_name) AS n_end_stations, min(started_at) AS first_trip, max(started_at) AS last_trip,
    {r(f'avg({MINUTES})', 'avg_duration_minutes')} FROM trips""",
)
trip_sql(
    "trips_by_station",
    """SELECT coalesce(d.station_name, a.station_name) AS station_name, coalesce(d.n, 0) AS departures,
    coalesce(a.n, 0) AS arrivals, coalesce(d.n, 0) + coalesce(a.n, 0) AS total_trips
    FROM dep d FULL OUTER JOIN arr a ON d.station_name = a.station_name""",
    SIDES,
)
trip_sql(
    "aggregate_trips",
    """SELECT start_station_name, rideable_type, count(*) AS trip_count, count(DISTINCT member_casual) AS riders,
    max(started_at) AS last_start FROM trips WHERE member_casual = 'member' GROUP BY 1, 2 ORDER BY 1, 2""",
)
trip_sql(
    "query_filter_limit",
    """SELECT ride_id, started_at, end_station_name FROM trips WHERE start_station_name IS NULL
    AND member_casual = 'casual' ORDER BY started_at, ride_id LIMIT 25""",
)
trip_sql(
    "date_range_trips",
    "SELECT ride_id, started_at FROM trips WHERE started_at >= '2024-01-05'::TIMESTAMP AND started_at <= '2024-01-12'::TIMESTAMP",
)
trip_sql("station_search", "SELECT ride_id, start_station_name FROM trips WHERE start_station_name LIKE '%\\_1%' ESCAPE '\\'")

HOUR = "CAST(hour(started_at) AS INTEGER) AS hour"
DOW = "CAST(isodow(started_at) - 1 AS INTEGER) AS day_of_week"
IS_WEEKEND = f"{WEEKEND.format('started_at')} AS is_weekend"
trip_sql("trips_by_hour", f"SELECT {HOUR}, count(*) AS trips FROM trips GROUP BY 1")
trip_sql("trips_by_day", f"SELECT {DOW}, dayname(started_at) AS day_name, count(*) AS trips FROM trips GROUP BY 1, 2")
trip_sql("trips_by_date", "SELECT CAST(CAST(started_at AS DATE) AS VARCHAR) AS date, count(*) AS trips FROM trips GROUP BY 1")
trip_sql("weekday_weekend_hourly", f"SELECT {IS_WEEKEND}, {HOUR}, count(*) AS trips FROM trips GROUP BY 1, 2")
trip_sql(
    "hour_dow_matrix",
    """SELECT d.day_of_week, h.hour, coalesce(c.trips, 0) AS trips
    FROM (SELECT DISTINCT day_of_week FROM cells) d CROSS JOIN (SELECT DISTINCT hour FROM cells) h
    LEFT JOIN cells c ON c.day_of_week = d.day_of_week AND c.hour = h.hour""",
    f"cells AS (SELECT {DOW}, {HOUR}, count(*) AS trips FROM trips GROUP BY 1, 2)",
)
trip_sql(
    "type_shares",
    f"""SELECT 'rideable_type' AS attribute, rideable_type AS value, count(*) AS trips,
    {r('count(*)::DOUBLE / (SELECT count(*) FROM trips)', 'share')} FROM trips GROUP BY rideable_type
    UNION ALL SELECT 'member_casual', member_casual, count(*),
    round(count(*)::DOUBLE / (SELECT count(*) FROM trips), 6) FROM trips GROUP BY member_casual""",
)
trip_sql("user_type_hourly", f"SELECT member_casual, {HOUR}, count(*) AS trips FROM trips GROUP BY 1, 2")
trip_sql("user_type_daily", f"SELECT member_casual, {DOW}, count(*) AS trips FROM trips GROUP BY 1, 2")


def describe(column: str, source: str) -> str:
    c = f"CAST({column} AS DOUBLE)"
    parts = [f"count({c}) AS count", r(f"avg({c})", "mean"), r(f"stddev_samp({c})", "std"), r(f"min({c})", "min")]
    parts += [r(f"quantile_cont({c}, {q})", f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
    parts.append(r(f"max({c})", "max"))
    return f"SELECT {', '.join(parts)} FROM {source}"


trip_sql("daily_count_describe", describe("trips", "days"), "days AS (SELECT CAST(started_at AS DATE) AS d, count(*) AS trips FROM trips GROUP BY 1)")
trip_sql("station_hourly", f"SELECT {HOUR}, count(*) AS departures FROM trips WHERE start_station_name = 'NATION_7' GROUP BY 1")
MONTHS = "SELECT year, month, count(*) AS trip_count FROM trips GROUP BY 1, 2"
trip_sql("trips_per_month", MONTHS)
item_sql("supplier_months", MONTHS)
MISSING = """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
    FROM (SELECT unnest(generate_series('{a}'::TIMESTAMP, '{b}'::TIMESTAMP, INTERVAL 1 MONTH)) AS m)
    WHERE NOT EXISTS (SELECT 1 FROM trips t WHERE t.year = year(m) AND t.month = month(m))"""
trip_sql("missing_months", MISSING.format(a="2023-10-01", b="2024-04-01"))
item_sql("supplier_missing_months", MISSING.format(a="1994-11-01", b="2002-02-01"))
trip_sql("od_counts", "SELECT * FROM od", OD)
trip_sql("top_routes", "SELECT * FROM od ORDER BY count DESC, start_station_name, end_station_name LIMIT 20", OD)
trip_sql(
    "self_loops",
    f"""SELECT count(*) AS self_loop_stations, CAST(sum(count) AS BIGINT) AS self_loop_trips,
    {r('sum(count) * 100.0::DOUBLE / (SELECT sum(count) FROM od)', 'self_loop_pct')}
    FROM od WHERE start_station_name = end_station_name""",
    OD,
)
trip_sql("route_count_describe", describe("count", "od"), OD)
item_sql("supplier_od_describe", describe("count", "od"), OD)
PARETO = """ranked AS (SELECT sum(count) OVER (ORDER BY count DESC, start_station_name, end_station_name
        ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(count) OVER () AS cum_pct FROM od)"""
PARETO_SQL = f"""SELECT CAST(p AS BIGINT) AS pct, count(*) FILTER (cum_pct <= p / 100.0::DOUBLE) + 1 AS n_routes,
    {r('(count(*) FILTER (cum_pct <= p / 100.0::DOUBLE) + 1) * 100.0::DOUBLE / count(*)', 'pct_of_routes')}
    FROM ranked CROSS JOIN (VALUES (50), (80), (90), (95)) v(p) GROUP BY p"""
trip_sql("route_pareto", PARETO_SQL, OD, PARETO)
item_sql("supplier_od_pareto", PARETO_SQL, OD, PARETO)
trip_sql(
    "route_cumulative_share",
    f"""SELECT o.count, count(*) AS routes, (SELECT count(*) FROM od x WHERE x.count >= o.count) AS cum_routes,
    (SELECT CAST(sum(x.count) AS BIGINT) FROM od x WHERE x.count >= o.count) AS cum_trips,
    {r('(SELECT sum(x.count) FROM od x WHERE x.count >= o.count)::DOUBLE / (SELECT sum(count) FROM od)', 'cum_pct')}
    FROM od o GROUP BY o.count""",
    OD,
)
trip_sql(
    "route_cdf",
    f"SELECT DISTINCT count, {r('cume_dist() OVER (ORDER BY count)', 'cdf')} FROM od",
    OD,
)
trip_sql(
    "route_diversity",
    f"""SELECT 'outgoing' AS direction, {r('avg(n)', 'mean')}, max(n) AS max
    FROM (SELECT count(DISTINCT end_station_name) AS n FROM od GROUP BY start_station_name)
    UNION ALL SELECT 'incoming', round(avg(n), 6), max(n)
    FROM (SELECT count(DISTINCT start_station_name) AS n FROM od GROUP BY end_station_name)""",
    OD,
)
N_STATIONS = """(SELECT count(*) FROM (SELECT start_station_name FROM trips WHERE start_station_name IS NOT NULL
    UNION SELECT end_station_name FROM trips WHERE end_station_name IS NOT NULL))"""
trip_sql(
    "sparsity",
    f"""SELECT n AS n_stations, n * n AS n_possible, (SELECT count(*) FROM od) AS n_observed,
    {r('1.0::DOUBLE - (SELECT count(*) FROM od)::DOUBLE / (n * n)', 'sparsity')} FROM (SELECT {N_STATIONS} AS n)""",
    OD,
)
trip_sql(
    "transition_shares",
    f"SELECT o.*, {r('o.count::DOUBLE / t.total', 'prob')} FROM od o JOIN (SELECT start_station_name AS s, sum(count) AS total FROM od GROUP BY 1) t ON t.s = o.start_station_name",
    OD,
)


def top_probs(n: int) -> tuple[str, str]:
    return (
        f"""SELECT s.start_station_name, e.end_station_name, coalesce(k.count, 0) AS count,
    {r('coalesce(k.count::DOUBLE / t.total, 0::DOUBLE)', 'prob')}
    FROM (SELECT DISTINCT start_station_name FROM kept) s CROSS JOIN (SELECT DISTINCT end_station_name FROM kept) e
    LEFT JOIN kept k ON k.start_station_name = s.start_station_name AND k.end_station_name = e.end_station_name
    JOIN (SELECT start_station_name, sum(count) AS total FROM kept GROUP BY 1) t ON t.start_station_name = s.start_station_name""",
        f"""top AS (SELECT station_name FROM activity ORDER BY total_trips DESC, station_name LIMIT {n}),
kept AS (SELECT * FROM od WHERE start_station_name IN (SELECT station_name FROM top)
    AND end_station_name IN (SELECT station_name FROM top))""",
    )


trip_sql("topn_transition_probs", top_probs(10)[0], ACTIVITY, OD, top_probs(10)[1])
item_sql("supplier_top_probs", top_probs(30)[0], ACTIVITY, OD, top_probs(30)[1])
trip_sql("busiest_stations", "SELECT * FROM activity ORDER BY total_trips DESC, station_name LIMIT 15", ACTIVITY)
trip_sql(
    "receivers_senders",
    """(SELECT *, 'receiver' AS side FROM activity ORDER BY net_flow DESC, station_name LIMIT 10)
    UNION ALL (SELECT *, 'sender' AS side FROM activity ORDER BY net_flow, station_name LIMIT 10)""",
    ACTIVITY,
)
trip_sql(
    "multi_id_stations",
    """SELECT start_station_name, count(DISTINCT start_station_id) AS n_ids FROM trips
    WHERE start_station_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT start_station_id) > 1""",
)
COORDS = """s_pos AS (SELECT start_station_name AS n, avg(start_lat) AS lat, avg(start_lng) AS lng FROM trips
    WHERE start_lat > 40.4 AND start_lat < 41.0 AND start_lng > -74.3 AND start_lng < -73.6 AND start_station_name IS NOT NULL GROUP BY 1),
e_pos AS (SELECT end_station_name AS n, avg(end_lat) AS lat, avg(end_lng) AS lng FROM trips
    WHERE end_lat > 40.4 AND end_lat < 41.0 AND end_lng > -74.3 AND end_lng < -73.6 AND end_station_name IS NOT NULL GROUP BY 1),
coords AS (SELECT coalesce(s.n, e.n) AS station_name, coalesce(s.lat, e.lat) AS lat, coalesce(s.lng, e.lng) AS lng
    FROM s_pos s FULL OUTER JOIN e_pos e ON s.n = e.n)"""
trip_sql("station_coords", f"SELECT station_name, {r('lat')}, {r('lng')} FROM coords", COORDS)
trip_sql(
    "station_locations",
    f"""SELECT a.*, {r('c.lat', 'lat')}, {r('c.lng', 'lng')}, {r('log10(a.total_trips + 1)', 'activity')}
    FROM activity a JOIN coords c ON a.station_name = c.station_name""",
    ACTIVITY,
    COORDS,
)
trip_sql("net_flow_q95", f"SELECT {r('quantile_cont(abs(net_flow)::DOUBLE, 0.95)', 'abs_net_flow')} FROM activity", ACTIVITY)
CENSUS = ["ride_id", "started_at", "start_station_name", "start_station_id", "end_station_name", "end_station_id", "end_lat"]
trip_sql(
    "null_census",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) FILTER ({cond}) AS nulls, round(count(*) FILTER ({cond}) * 100.0::DOUBLE / count(*), 2) AS pct FROM trips"
        for name, cond in [(c, f"{c} IS NULL") for c in CENSUS] + [("any", " OR ".join(f"{c} IS NULL" for c in CENSUS))]
    )
    + ") WHERE nulls > 0",
)
DURATIONS = " UNION ALL ".join(
    f"SELECT '{stat}' AS stat, round({expr}, 6) + 0.0::DOUBLE AS value FROM d"
    for stat, expr in [
        ("count", "count(m)::DOUBLE"),
        ("mean", "avg(m)"),
        ("std", "stddev_samp(m)"),
        ("min", "min(m)"),
        ("max", "max(m)"),
        ("q25", "quantile_cont(m, 0.25)"),
        ("q50", "quantile_cont(m, 0.5)"),
        ("q75", "quantile_cont(m, 0.75)"),
    ]
)
D = f"d AS (SELECT {MINUTES} AS m, rideable_type FROM trips)"
trip_sql("duration_describe", DURATIONS, D)
item_sql("supplier_durations", DURATIONS, D)
trip_sql(
    "duration_anomalies",
    """SELECT count(*) FILTER (m < 0) AS negative, count(*) FILTER (m = 0) AS zero, count(*) FILTER (m > 60) AS over_hour,
    count(*) FILTER (m > 1440) AS over_day, count(*) FILTER (m > 0 AND m <= 60) AS plausible FROM d""",
    D,
)
trip_sql(
    "plausible_durations",
    f"SELECT rideable_type, count(*) AS trips, {r('avg(m)', 'mean_minutes')} FROM d WHERE m > 0 AND m <= 60 GROUP BY 1",
    D,
)
trip_sql(
    "network_summary",
    f"""SELECT count(*) AS total_trips, CAST(CAST(min(started_at) AS DATE) AS VARCHAR) AS first_date, CAST(CAST(max(started_at) AS DATE) AS VARCHAR) AS last_date,
    {r("avg((rideable_type = 'click')::INT)", 'share_click')}, {r("avg((rideable_type = 'view')::INT)", 'share_view')},
    {r("avg((member_casual = 'member')::INT)", 'share_member')}, {r("avg((member_casual = 'casual')::INT)", 'share_casual')},
    count(*) FILTER (start_station_name IS NULL) + count(*) FILTER (end_station_name IS NULL) AS missing_entries,
    {N_STATIONS} AS n_stations, (SELECT count(*) FROM od) AS n_routes, {r(f'median({MINUTES})', 'median_minutes')},
    (SELECT CAST(sum(count) AS BIGINT) FROM od WHERE start_station_name = end_station_name) AS self_loop_trips,
    {r('(SELECT sum(count) FILTER (start_station_name = end_station_name) * 100.0::DOUBLE / sum(count) FROM od)', 'self_loop_pct')},
    {r('(SELECT avg(n) FROM (SELECT count(*) AS n FROM od GROUP BY start_station_name))', 'mean_destinations')},
    {r('(SELECT avg(n) FROM (SELECT count(*) AS n FROM od GROUP BY end_station_name))', 'mean_origins')},
    {r(f'1.0::DOUBLE - (SELECT count(*) FROM od)::DOUBLE / ({N_STATIONS} * {N_STATIONS})', 'sparsity')} FROM trips""",
    OD,
)
trip_sql(
    "hourly_od_summary",
    f"""SELECT date_trunc('hour', started_at) AS hour, start_station_name, end_station_name,
    CAST(hour(started_at) AS INTEGER) AS hour_of_day, {IS_WEEKEND}, count(*) AS trip_count,
    {r(f'avg({MINUTES})', 'avg_duration_minutes')} FROM trips GROUP BY 1, 2, 3, 4, 5""",
)
trip_sql(
    "od_by_hour",
    """SELECT date_trunc('hour', started_at) AS bucket, start_station_name AS from_station, end_station_name AS to_station,
    count(*) AS trips FROM trips WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL GROUP BY 1, 2, 3""",
)


def flows(source: str, bucket: str) -> str:
    return f"""flow_d AS (SELECT start_station_name AS station_name, {bucket} AS bucket, count(*) AS n FROM {source}
    WHERE start_station_name IS NOT NULL GROUP BY 1, 2),
flow_a AS (SELECT end_station_name AS station_name, {bucket} AS bucket, count(*) AS n FROM {source}
    WHERE end_station_name IS NOT NULL GROUP BY 1, 2),
flows AS (SELECT coalesce(d.station_name, a.station_name) AS station_name, coalesce(d.bucket, a.bucket) AS bucket,
    coalesce(d.n, 0) AS departures, coalesce(a.n, 0) AS arrivals, coalesce(a.n, 0) - coalesce(d.n, 0) AS net
    FROM flow_d d FULL OUTER JOIN flow_a a ON d.station_name = a.station_name AND d.bucket = a.bucket)"""


HOURLY = "date_trunc('hour', started_at)"
trip_sql("flow_by_hour", "SELECT * FROM flows", flows("trips", HOURLY))
trip_sql("flow_by_quarter_hour", "SELECT * FROM flows", flows("trips", "time_bucket(INTERVAL 15 MINUTE, started_at)"))
trip_sql(
    "trips_per_capacity",
    f"""SELECT t.start_station_name, s.capacity, count(*) AS trip_count, {r('count(*) / nullif(s.capacity, 0)', 'trips_per_capacity')}
    FROM trips t LEFT JOIN docks s ON t.start_station_id = s.station_id
    WHERE s.capacity IS NOT NULL AND t.year = 2024 AND t.month = 1 GROUP BY 1, 2
    ORDER BY count(*) / nullif(s.capacity, 0) DESC NULLS LAST, 1 LIMIT 20""",
    DOCKS,
)

# -- sources ------------------------------------------------------------------

ORACLES["unified_view"] = f"""WITH {TRIPS},
{ITEMS.replace('trips AS', 'items AS', 1)}
SELECT CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, count(*) AS trips, count(start_station_id) AS with_station_id,
    count(start_station_name) AS with_station_name, min(started_at) AS first_start FROM trips
UNION ALL SELECT 2001, 11, count(*), 0, count(start_station_name), min(started_at) FROM items"""
FEED = """homes AS (SELECT *, s_nationkey % 5 AS home FROM supplier),
copies AS (SELECT *, home AS r FROM homes UNION ALL SELECT *, (home + 1) % 5 AS r FROM homes WHERE s_suppkey % 3 = 0),
feed AS (SELECT CASE r WHEN 0 THEN 'bkn' WHEN 1 THEN 'man' WHEN 2 THEN 'que' WHEN 3 THEN 'jc' ELSE 'nyc' END AS region, r,
    CAST(s_suppkey AS VARCHAR) AS station_id, 'N' || CAST(s_suppkey AS VARCHAR) AS short_name, s_name AS name,
    CASE WHEN s_suppkey % 10 = 7 THEN NULL ELSE CAST(s_suppkey % 31 + 10 + r AS DOUBLE) END AS capacity,
    round(40.0::DOUBLE + s_suppkey % 100 * 0.01::DOUBLE, 6) AS lat, round(-74.0::DOUBLE + s_suppkey % 100 * 0.01::DOUBLE, 6) AS lng,
    CAST(s_nationkey AS VARCHAR) AS region_id, 'classic' AS station_type, s_suppkey % 2 = 0 AS has_kiosk FROM copies),
firsts AS (SELECT * FROM feed f WHERE r = (SELECT min(r) FROM feed g WHERE g.station_id = f.station_id))"""
ORACLES["feed_explode"] = f"WITH {FEED} SELECT * EXCLUDE (r) FROM feed"
ORACLES["feed_dedupe"] = f"WITH {FEED} SELECT station_id, name, short_name, lat, lng, capacity, region_id, region FROM firsts"
ORACLES["station_summary"] = f"""WITH {FEED} SELECT count(*) AS total_stations, sum(capacity) AS total_capacity,
    {r('avg(capacity)', 'avg_capacity')}, min(capacity) AS min_capacity, max(capacity) AS max_capacity,
    count(*) FILTER (capacity IS NULL) AS missing_capacity FROM firsts"""
ORACLES["stations_per_region"] = f"WITH {FEED} SELECT region_id, count(*) AS stations FROM firsts GROUP BY 1"
ORACLES["station_labels"] = """WITH names AS (SELECT s_suppkey, s_name || ' & ' || n_name || ' & ' || repeat('x', CAST(s_suppkey % 17 AS INTEGER)) AS name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN length(name) > 40 THEN left(name, 37) || '...' ELSE name END AS label FROM names"""
item_sql(
    "csv_roundtrip",
    f"""SELECT m.year, m.month, m.csv_rows, m.csv_rows AS parquet_rows, true AS success, coalesce(k.read_rows, 0) AS read_rows, k.last_start,
    {r('coalesce(k.minutes, 0)', 'minutes')} FROM (SELECT year, month, count(*) AS csv_rows FROM trips GROUP BY 1, 2) m
    LEFT JOIN (SELECT year, month, count(*) AS read_rows, max(started_at) AS last_start, sum({MINUTES}) AS minutes FROM trips
        WHERE started_at >= '1995-03-15' AND started_at <= '2001-06-30' GROUP BY 1, 2) k ON k.year = m.year AND k.month = m.month""",
)

READ = f"""SELECT member_casual, start_station_name, count(*) AS trips, min(started_at) AS first_start, {r(f'sum({MINUTES})', 'minutes')},
    count(DISTINCT end_station_id) AS end_ids"""
trip_sql("csv_trips", f"{READ} FROM trips WHERE started_at >= '2024-01-04' AND started_at < '2024-01-26' GROUP BY 1, 2")
trip_sql(
    "chosen_source",
    " UNION ALL ".join(
        f"""{READ}, '{name}' AS source FROM trips WHERE started_at >= '2024-01-04' AND started_at <= '2024-01-25' AND {riders} GROUP BY 1, 2"""
        for name, riders in (("before", "member_casual = 'casual'"), ("parquet", "true"), ("csv", "member_casual = 'casual'"))
    ),
)
trip_sql(
    "conversion_totals",
    """SELECT count(*) AS successful, CAST(0 AS BIGINT) AS failed, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(bad) AS BIGINT) AS unread_starts
    FROM (SELECT year, month, count(*) AS n, count(*) FILTER (started_at IS NULL) AS bad FROM trips GROUP BY 1, 2)""",
)
ORACLES["station_files"] = """WITH docks AS (
    SELECT 'S' || CAST(n_nationkey AS VARCHAR) || '-0' AS station_id, n_name AS name,
        CASE WHEN n_nationkey <> 3 THEN CAST(10 + (n_nationkey * 7) % 31 AS DOUBLE) END AS capacity,
        round(40.45::DOUBLE + n_nationkey * 0.02::DOUBLE, 6) AS lat, round(-74.2::DOUBLE + n_nationkey * 0.02::DOUBLE, 6) AS lng,
        CAST(n_regionkey AS VARCHAR) AS region_id FROM nation WHERE n_nationkey <> 5)
SELECT *, 'csv' AS source FROM docks UNION ALL SELECT *, 'parquet' FROM docks WHERE capacity IS NOT NULL"""
trip_sql(
    "exported_trips",
    """SELECT member_casual, CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, count(*) AS trips, count(start_station_name) AS named,
    max(started_at) AS last_start FROM trips GROUP BY 1, 2""",
)
ORACLES["stored_hourly_summary"] = ORACLES["hourly_od_summary"]

# -- preparation, folds, inventories -------------------------------------------


def prepared(min_trips: int) -> str:
    return f"""named AS (SELECT * FROM trips WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL),
valid AS (SELECT d.s AS station_name FROM (SELECT start_station_name AS s, count(*) AS n FROM named GROUP BY 1) d
    JOIN (SELECT end_station_name AS s, count(*) AS n FROM named GROUP BY 1) a ON d.s = a.s WHERE d.n + a.n >= {min_trips}),
kept AS (SELECT * FROM named WHERE start_station_name IN (SELECT station_name FROM valid)
    AND end_station_name IN (SELECT station_name FROM valid)),
stats AS (SELECT v.station_name, CASE WHEN d.name IS NOT NULL THEN d.capacity
        ELSE (SELECT median(x.capacity) FROM docks x WHERE x.name IN (SELECT station_name FROM valid)) END AS capacity
    FROM valid v LEFT JOIN docks d ON d.name = v.station_name),
{flows('kept', HOURLY)}"""


def folds_sql(train: int, test: int, step: int, source: str = "kept", name: str = "folds") -> str:
    tr, te = 7 * train, 7 * test
    return f"""{name}_span AS (SELECT date_trunc('day', min(started_at)) AS a, date_trunc('day', max(started_at)) AS b FROM {source}),
{name} AS (SELECT CAST(i AS INTEGER) AS fold_id, a + to_days(CAST(i * {step} AS INTEGER)) AS train_start,
    a + to_days(CAST(i * {step} + {tr} AS INTEGER)) AS train_end, a + to_days(CAST(i * {step} + {tr} AS INTEGER)) AS test_start,
    a + to_days(CAST(i * {step} + {tr + te} AS INTEGER)) AS test_end
    FROM {name}_span, generate_series(0, 4000) g(i) WHERE a + to_days(CAST(i * {step} + {tr + te} AS INTEGER)) <= b)"""


PREP, SELECTIVE_PREP = DOCKS + ",\n" + prepared(100), DOCKS + ",\n" + prepared(780)
FOLDS = folds_sql(2, 1, 1)

# Burn-in by running the hours in order, and truth by the running totals of the
# grid; folds by range conditions.
INIT = """burn AS (SELECT f.fold_id, w.station_name, w.net, row_number() OVER (PARTITION BY f.fold_id, w.station_name ORDER BY w.bucket) AS i
    FROM folds f JOIN flows w ON w.bucket >= f.test_start - INTERVAL 7 DAY AND w.bucket < f.test_start),
burn_walk AS (SELECT fold_id, station_name, i, greatest(0, net) AS x FROM burn WHERE i = 1
    UNION ALL SELECT b.fold_id, b.station_name, b.i, greatest(0, w.x + b.net) FROM burn_walk w
    JOIN burn b ON b.fold_id = w.fold_id AND b.station_name = w.station_name AND b.i = w.i + 1),
init AS (SELECT f.fold_id, s.station_name, s.capacity, f.test_start,
    least(CASE WHEN EXISTS (SELECT 1 FROM burn b WHERE b.fold_id = f.fold_id) THEN coalesce(last.x, 0)::DOUBLE ELSE 15.0::DOUBLE END,
        coalesce(s.capacity, 30.0::DOUBLE)) AS bikes
    FROM folds f CROSS JOIN stats s LEFT JOIN (SELECT fold_id, station_name, arg_max(x, i) AS x FROM burn_walk GROUP BY 1, 2) last
    ON last.fold_id = f.fold_id AND last.station_name = s.station_name)"""
TRUTH = """truth AS (SELECT fold_id, station_name, 0 AS i, test_start AS ts, bikes, capacity FROM init
    UNION ALL SELECT t.fold_id, t.station_name, t.i + 1, t.ts + INTERVAL 1 HOUR, greatest(0.0::DOUBLE, t.bikes + coalesce(w.net, 0)), t.capacity
    FROM truth t LEFT JOIN flows w ON w.station_name = t.station_name AND w.bucket = t.ts WHERE t.i < 167)"""
FACTS = f"""facts AS (SELECT f.fold_id, count(DISTINCT date_trunc('hour', k.started_at)) AS train_hours,
    count(DISTINCT CAST(k.started_at AS DATE)) FILTER (NOT {WEEKEND.format('k.started_at')}) AS train_weekdays,
    count(DISTINCT CAST(k.started_at AS DATE)) FILTER ({WEEKEND.format('k.started_at')}) AS train_weekend_days
    FROM folds f JOIN kept k ON k.started_at >= f.train_start AND k.started_at < f.train_end GROUP BY 1)"""
AVG_FIT = """avg_fit AS (SELECT fold_id, station_name, net::DOUBLE / greatest(train_hours, 1) AS avg_flow FROM
    (SELECT f.fold_id, w.station_name, sum(w.net) AS net FROM folds f JOIN flows w ON w.bucket >= f.train_start AND w.bucket < f.train_end GROUP BY 1, 2)
    JOIN facts USING (fold_id)),
avg_all AS (SELECT fold_id, avg(avg_flow) AS global_flow FROM avg_fit GROUP BY 1)"""
FLOW_FIT = f"""flow_fit AS (SELECT fold_id, station_name, hour, is_weekend,
        net::DOUBLE / greatest(CASE WHEN is_weekend THEN train_weekend_days ELSE train_weekdays END, 1) AS avg_flow FROM
    (SELECT f.fold_id, w.station_name, CAST(hour(w.bucket) AS INTEGER) AS hour, {WEEKEND.format('w.bucket')} AS is_weekend, sum(w.net) AS net
        FROM folds f JOIN flows w ON w.bucket >= f.train_start AND w.bucket < f.train_end GROUP BY 1, 2, 3, 4)
    JOIN facts USING (fold_id)),
flow_all AS (SELECT fold_id, avg(avg_flow) AS global_flow FROM flow_fit GROUP BY 1)"""
AVG_WALK = """avg_walk AS (SELECT fold_id, station_name, 0 AS i, test_start AS ts, bikes, capacity FROM init
    UNION ALL SELECT t.fold_id, t.station_name, t.i + 1, t.ts + INTERVAL 1 HOUR,
        least(coalesce(t.capacity, 30.0::DOUBLE), greatest(0.0::DOUBLE, t.bikes + coalesce(p.avg_flow, g.global_flow))), t.capacity
    FROM avg_walk t LEFT JOIN avg_fit p ON p.fold_id = t.fold_id AND p.station_name = t.station_name
    JOIN avg_all g ON g.fold_id = t.fold_id WHERE t.i < 167)"""
FLOW_WALK = f"""flow_walk AS (SELECT fold_id, station_name, 0 AS i, test_start AS ts, bikes, capacity FROM init
    UNION ALL SELECT t.fold_id, t.station_name, t.i + 1, t.ts + INTERVAL 1 HOUR,
        least(coalesce(t.capacity, 30.0::DOUBLE), greatest(0.0::DOUBLE, t.bikes + coalesce(p.avg_flow, g.global_flow))), t.capacity
    FROM flow_walk t LEFT JOIN flow_fit p ON p.fold_id = t.fold_id AND p.station_name = t.station_name
        AND p.hour = hour(t.ts + INTERVAL 1 HOUR) AND p.is_weekend = {WEEKEND.format('(t.ts + INTERVAL 1 HOUR)')}
    JOIN flow_all g ON g.fold_id = t.fold_id WHERE t.i < 167)"""
STAY = "stay AS (SELECT fold_id, station_name, i, ts, capacity, (SELECT bikes FROM init n WHERE n.fold_id = t.fold_id AND n.station_name = t.station_name) AS bikes FROM truth t)"


def recursive(name: str, sql: str, *ctes: str, base: str = TRIPS) -> None:
    ORACLES[name] = "WITH RECURSIVE " + ",\n".join([base, *ctes]) + "\n" + sql


trip_sql(
    "prepared_trips",
    f"SELECT ride_id, start_station_name, end_station_name, {HOUR}, {DOW}, CAST(CAST(started_at AS DATE) AS VARCHAR) AS date, {IS_WEEKEND} FROM kept",
    SELECTIVE_PREP,
)
trip_sql("station_stats", "SELECT * FROM stats", SELECTIVE_PREP)
MONTH_CTES = """listed AS (SELECT DISTINCT name FROM docks),
inner_trips AS (SELECT * FROM trips WHERE start_station_name IN (SELECT name FROM listed) AND end_station_name IN (SELECT name FROM listed)),
seen AS (SELECT DISTINCT CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month, n AS station_name FROM
    (SELECT started_at, start_station_name AS n FROM trips UNION ALL SELECT started_at, end_station_name FROM trips) WHERE n IN (SELECT name FROM listed)),
""" + flows("inner_trips", HOURLY) + """,
monthly AS (SELECT CAST(year(bucket) AS INTEGER) AS year, CAST(month(bucket) AS INTEGER) AS month, station_name, bucket, net,
    row_number() OVER (PARTITION BY year(bucket), month(bucket), station_name ORDER BY bucket) AS i,
    row_number() OVER (PARTITION BY year(bucket), month(bucket), station_name ORDER BY bucket DESC) AS j FROM flows),
forward AS (SELECT year, month, station_name, i, greatest(0, net) AS x FROM monthly WHERE i = 1
    UNION ALL SELECT m.year, m.month, m.station_name, m.i, greatest(0, f.x + m.net) FROM forward f JOIN monthly m
    ON m.year = f.year AND m.month = f.month AND m.station_name = f.station_name AND m.i = f.i + 1),
backward AS (SELECT year, month, station_name, j, greatest(0, -net) AS x FROM monthly WHERE j = 1
    UNION ALL SELECT m.year, m.month, m.station_name, m.j, greatest(0, b.x - m.net) FROM backward b JOIN monthly m
    ON m.year = b.year AND m.month = b.month AND m.station_name = b.station_name AND m.j = b.j + 1),
inferred AS (SELECT s.year, s.month, s.station_name, coalesce(b.x, 0) AS start_bikes, coalesce(f.x, 0) AS end_bikes FROM seen s
    LEFT JOIN (SELECT year, month, station_name, arg_max(x, i) AS x FROM forward GROUP BY ALL) f USING (year, month, station_name)
    LEFT JOIN (SELECT year, month, station_name, arg_max(x, j) AS x FROM backward GROUP BY ALL) b USING (year, month, station_name))"""
recursive("month_inventory", "SELECT * FROM inferred", DOCKS, MONTH_CTES)
recursive("supplier_month_inventory", "SELECT * FROM inferred", ITEM_DOCKS, MONTH_CTES, base=ITEMS)
recursive("month_inventory_files", "SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, station_name, start_bikes, end_bikes FROM inferred", DOCKS, MONTH_CTES)
recursive(
    "top_start_inventory",
    """SELECT *, CAST(row_number() OVER (PARTITION BY year, month ORDER BY start_bikes DESC, station_name) AS INTEGER) AS rank
    FROM inferred QUALIFY rank <= 10""",
    ITEM_DOCKS,
    MONTH_CTES,
    base=ITEMS,
)
recursive(
    "month_inventory_summary",
    """SELECT t.*, n_stations, total_bikes_start, total_bikes_end FROM
    (SELECT CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month, count(*) AS n_trips,
        min(started_at) AS start_time, max(started_at) AS end_time FROM trips GROUP BY 1, 2) t
    JOIN (SELECT year, month, count(*) AS n_stations, CAST(sum(start_bikes) AS BIGINT) AS total_bikes_start,
        CAST(sum(end_bikes) AS BIGINT) AS total_bikes_end FROM inferred GROUP BY 1, 2) i ON i.year = t.year AND i.month = t.month""",
    DOCKS,
    MONTH_CTES,
)
recursive(
    "running_inventory",
    "SELECT station_name, bucket, x AS bikes FROM walk",
    flows("trips", HOURLY),
    """seq AS (SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY bucket) AS i FROM flows),
walk AS (SELECT station_name, bucket, i, greatest(0.0::DOUBLE, 5.0::DOUBLE + net) AS x FROM seq WHERE i = 1
    UNION ALL SELECT s.station_name, s.bucket, s.i, greatest(0.0::DOUBLE, w.x + s.net) FROM walk w JOIN seq s ON s.station_name = w.station_name AND s.i = w.i + 1)""",
)
recursive(
    "clamped_inventory",
    "SELECT station_name, CAST(date_diff('hour', TIMESTAMP '1990-01-01', bucket) AS BIGINT) AS hour, net, x AS bikes FROM walk",
    flows("trips", HOURLY),
    """seq AS (SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY bucket) AS i, length(station_name) + 1::DOUBLE AS full_ FROM flows),
walk AS (SELECT station_name, bucket, i, net, least(full_, greatest(0.0::DOUBLE, 3.5::DOUBLE + net)) AS x FROM seq WHERE i = 1
    UNION ALL SELECT s.station_name, s.bucket, s.i, s.net, least(s.full_, greatest(0.0::DOUBLE, w.x + s.net)) FROM walk w JOIN seq s ON s.station_name = w.station_name AND s.i = w.i + 1)""",
    base=ITEMS,
)
trip_sql("cv_folds", "SELECT * FROM folds", folds_sql(2, 1, 1, "trips"))
item_sql("cv_folds_default_step", "SELECT * FROM folds", folds_sql(3, 1, 7, "trips"))
trip_sql(
    "fold_trip_counts",
    """SELECT f.*, (SELECT count(*) FROM kept k WHERE k.started_at >= train_start AND k.started_at < train_end) AS train_trips,
    (SELECT count(*) FROM kept k WHERE k.started_at >= test_start AND k.started_at < test_end) AS test_trips,
    (SELECT count(*) FROM kept k WHERE k.started_at >= test_start - INTERVAL 7 DAY AND k.started_at < test_start) AS burn_in_trips
    FROM folds f""",
    PREP,
    FOLDS,
)
trip_sql(
    "fold_facts",
    """SELECT f.*, train_hours, train_weekdays, train_weekend_days,
    (SELECT count(DISTINCT date_trunc('hour', k.started_at)) FROM kept k WHERE k.started_at >= test_start AND k.started_at < test_end) AS test_hours,
    EXISTS (SELECT 1 FROM kept k WHERE k.started_at >= test_start - INTERVAL 7 DAY AND k.started_at < test_start) AS has_burn_in
    FROM folds f JOIN facts USING (fold_id)""",
    PREP,
    FOLDS,
    FACTS,
)
recursive("initial_inventory", "SELECT fold_id, station_name, capacity, bikes FROM init", PREP, FOLDS, INIT)
recursive("tracked_inventory", "SELECT fold_id, station_name, ts, bikes FROM truth", PREP, FOLDS, INIT, TRUTH)

# -- forecasts ----------------------------------------------------------------

trip_sql(
    "fit_station_avg",
    f"SELECT fold_id, station_name, {r('avg_flow')}, {r('global_flow')} FROM avg_fit JOIN avg_all USING (fold_id)",
    PREP,
    FOLDS,
    FACTS,
    AVG_FIT,
)
trip_sql(
    "fit_temporal_flow",
    f"SELECT fold_id, station_name, hour, is_weekend, {r('avg_flow')}, {r('global_flow')} FROM flow_fit JOIN flow_all USING (fold_id)",
    PREP,
    FOLDS,
    FACTS,
    FLOW_FIT,
)
WHOLE = """folds AS (SELECT 0 AS fold_id, date_trunc('day', min(started_at)) AS train_start,
    date_trunc('day', max(started_at)) + INTERVAL 1 DAY AS train_end FROM kept)"""
trip_sql(
    "flow_model_reports",
    f"""SELECT 'station_avg' AS model, count(*) AS n_params, {r('avg(avg_flow)', 'global_avg_flow')} FROM avg_fit
    UNION ALL SELECT 'temporal_flow', count(*), round(avg(avg_flow), 6) + 0.0::DOUBLE FROM flow_fit""",
    PREP,
    WHOLE,
    FACTS,
    AVG_FIT,
    FLOW_FIT,
)
PATH = f"SELECT fold_id, station_name, ts, {r('bikes')} FROM "
recursive("forecast_persistence", PATH + "stay", PREP, FOLDS, INIT, TRUTH, STAY)
recursive("forecast_station_avg", PATH + "avg_walk", PREP, FOLDS, INIT, FACTS, AVG_FIT, AVG_WALK)
recursive("forecast_temporal_flow", PATH + "flow_walk", PREP, FOLDS, INIT, FACTS, FLOW_FIT, FLOW_WALK)


def state(bikes: str, capacity: str = "capacity") -> str:
    return f"""CASE WHEN {bikes} <= coalesce({capacity}, 30) * 0.1::DOUBLE THEN 'empty'
    WHEN {bikes} >= coalesce({capacity}, 30) * 0.9::DOUBLE THEN 'full' ELSE 'normal' END"""


recursive(
    "forecast_states",
    f"SELECT fold_id, station_name, {state('bikes')} AS state, count(*) AS hours FROM avg_walk GROUP BY ALL",
    PREP,
    FOLDS,
    INIT,
    FACTS,
    AVG_FIT,
    AVG_WALK,
)


def metric_ctes(models: dict[str, str]) -> str:
    union = " UNION ALL ".join(f"SELECT '{m}' AS model, fold_id, station_name, ts, bikes FROM {t}" for m, t in models.items())
    scores = []
    for s in ("empty", "full"):
        tp, fp, fn = (
            f"count(*) FILTER (ts_ = '{s}' AND ps_ = '{s}')",
            f"count(*) FILTER (ts_ <> '{s}' AND ps_ = '{s}')",
            f"count(*) FILTER (ts_ = '{s}' AND ps_ <> '{s}')",
        )
        p = f"coalesce({tp}::DOUBLE / nullif({tp} + {fp}, 0), 0)"
        c = f"coalesce({tp}::DOUBLE / nullif({tp} + {fn}, 0), 0)"
        scores += [
            f"{p} AS {s}_precision",
            f"{c} AS {s}_recall",
            f"coalesce(2 * {p} * {c} / nullif({p} + {c}, 0), 0) AS {s}_f1",
            f"count(*) FILTER (ts_ = '{s}') AS {s}_count",
            f"count(*) FILTER (ps_ = '{s}') AS {s}_predicted_count",
        ]
    return f"""pairs AS (SELECT p.model, p.fold_id, p.station_name, p.ts, t.bikes AS t, p.bikes AS p,
        {state('t.bikes', 't.capacity')} AS ts_, {state('p.bikes', 't.capacity')} AS ps_
    FROM truth t JOIN ({union}) p ON p.fold_id = t.fold_id AND p.station_name = t.station_name AND p.ts = t.ts),
maes AS (SELECT model, fold_id, avg(m) AS station_mae_mean, stddev_pop(m) AS station_mae_std FROM
    (SELECT model, fold_id, station_name, avg(abs(t - p)) AS m FROM pairs GROUP BY 1, 2, 3) GROUP BY 1, 2),
scores AS (SELECT model, fold_id, avg(abs(t - p)) AS inventory_mae, sqrt(avg((t - p) * (t - p))) AS inventory_rmse,
    avg(abs(t - p) / (abs(t) + 1)) AS inventory_mape, count(*) AS n_predictions, count(DISTINCT station_name) AS n_stations,
    count(DISTINCT ts) AS n_time_periods,
    CASE WHEN min(t) = max(t) OR min(p) = max(p) THEN 0 ELSE covar_pop(t, p) / (stddev_pop(t) * stddev_pop(p)) END AS correlation,
    {', '.join(scores)}, avg((ts_ = ps_)::INT) AS state_accuracy FROM pairs GROUP BY 1, 2),
metrics AS (SELECT * FROM scores JOIN maes USING (model, fold_id))"""


METRIC_LIST = [
    "inventory_mae", "inventory_rmse", "inventory_mape", "n_predictions", "n_stations", "n_time_periods", "correlation",
    "empty_precision", "empty_recall", "empty_f1", "empty_count", "empty_predicted_count", "full_precision", "full_recall",
    "full_f1", "full_count", "full_predicted_count", "state_accuracy", "station_mae_mean", "station_mae_std",
]


def metric_columns(prefix: str = "") -> str:
    counts = ("n_", "empty_count", "empty_predicted_count", "full_count", "full_predicted_count")
    return ", ".join(f"{prefix}{m}" if m.startswith(counts) else r(prefix + m, m) for m in METRIC_LIST)


MODELS3 = {"persistence": "stay", "station_avg": "avg_walk", "temporal_flow": "flow_walk"}
ALL3 = (PREP, FOLDS, INIT, TRUTH, STAY, FACTS, AVG_FIT, AVG_WALK, FLOW_FIT, FLOW_WALK, metric_ctes(MODELS3))
DATES = "CAST(CAST(f.train_start AS DATE) AS VARCHAR) AS train_start, CAST(CAST(f.test_start AS DATE) AS VARCHAR) AS test_start"
recursive("fold_metrics", f"SELECT model, fold_id, {metric_columns()}, {DATES} FROM metrics JOIN folds f USING (fold_id)", *ALL3)
recursive(
    "state_confusion",
    "SELECT fold_id, ts_ AS true_state, ps_ AS pred_state, count(*) AS cells FROM pairs WHERE model = 'persistence' GROUP BY ALL",
    *ALL3,
)
SUMMARY = "summary AS (" + " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, avg({m}) AS mean, stddev_pop({m}) AS std FROM metrics GROUP BY 1" for m in METRIC_LIST
) + ")"
recursive("cv_summary", f"SELECT model, metric, {r('mean')}, {r('std')} FROM summary", *ALL3, SUMMARY)
recursive(
    "result_documents",
    f"SELECT model, fold_id, {r('inventory_mae')}, {r('full_recall')}, {DATES} FROM metrics JOIN folds f USING (fold_id)",
    *ALL3,
)
recursive(
    "stored_summary",
    f"""SELECT model, metric, {r('mean')}, {r('std')}, '2 weeks' AS config, CAST(42 AS INTEGER) AS random_seed, '20240102_000000' AS run_ts,
    {r('mean', 'document_mean')}, {r('std', 'document_std')} FROM summary""",
    *ALL3,
    SUMMARY,
)
recursive(
    "supplier_fold_metrics",
    f"SELECT model, fold_id, {metric_columns()}, {DATES} FROM metrics JOIN folds f USING (fold_id)",
    ITEM_DOCKS,
    prepared(100),
    folds_sql(8, 1, 63),
    INIT,
    TRUTH,
    STAY,
    FACTS,
    FLOW_FIT,
    FLOW_WALK,
    metric_ctes({"persistence": "stay", "temporal_flow": "flow_walk"}),
    base=ITEMS,
)

# -- Markov -------------------------------------------------------------------


def markov(min_pairs: int) -> str:
    return f"""moves AS (SELECT f.fold_id, CAST(hour(k.started_at) AS INTEGER) AS hour, {WEEKEND.format('k.started_at')} AS is_weekend,
        k.start_station_name AS from_station, k.end_station_name AS to_station, k.started_at
    FROM folds f JOIN kept k ON k.started_at >= f.train_start AND k.started_at < f.train_end),
ctx_od AS (SELECT fold_id, hour, is_weekend, from_station, to_station, count(*) AS trips FROM moves GROUP BY ALL),
ctx_dep AS (SELECT fold_id, hour, is_weekend, from_station, count(*) AS dep FROM moves GROUP BY ALL),
ctx_days AS (SELECT fold_id, hour, is_weekend, count(DISTINCT CAST(started_at AS DATE)) AS n_days FROM moves GROUP BY ALL),
ctx_pairs AS (SELECT fold_id, hour, is_weekend, count(*) AS n_pairs FROM ctx_od GROUP BY ALL),
contexts AS (SELECT f.fold_id, CAST(h AS INTEGER) AS hour, w AS is_weekend, coalesce(n_pairs, 0) AS n_pairs, coalesce(n_days, 1) AS n_days,
        coalesce(n_pairs, 0) >= {min_pairs} AS valid
    FROM folds f CROSS JOIN generate_series(0, 23) g(h) CROSS JOIN (VALUES (true), (false)) v(w)
    LEFT JOIN ctx_pairs p ON p.fold_id = f.fold_id AND p.hour = h AND p.is_weekend = w
    LEFT JOIN ctx_days d ON d.fold_id = f.fold_id AND d.hour = h AND d.is_weekend = w),
own AS (SELECT o.fold_id, o.hour, o.is_weekend, o.from_station, o.to_station, o.trips, o.trips::DOUBLE / d.dep AS prob, d.dep::DOUBLE / c.n_days AS rate
    FROM ctx_od o JOIN ctx_dep d USING (fold_id, hour, is_weekend, from_station) JOIN contexts c USING (fold_id, hour, is_weekend) WHERE c.valid),
fallback AS (SELECT o.fold_id, o.from_station, o.to_station, o.trips, o.trips::DOUBLE / d.dep AS prob, d.dep::DOUBLE / greatest(h.n, 1) AS rate
    FROM (SELECT fold_id, from_station, to_station, count(*) AS trips FROM moves GROUP BY ALL) o
    JOIN (SELECT fold_id, from_station, count(*) AS dep FROM moves GROUP BY ALL) d USING (fold_id, from_station)
    JOIN (SELECT fold_id, count(DISTINCT date_trunc('hour', started_at)) AS n FROM moves GROUP BY 1) h USING (fold_id)),
edges AS (SELECT fold_id, hour, is_weekend, from_station, to_station, prob, rate FROM own
    UNION ALL SELECT c.fold_id, c.hour, c.is_weekend, b.from_station, b.to_station, b.prob, b.rate FROM contexts c JOIN fallback b USING (fold_id) WHERE NOT c.valid),
own_rates AS (SELECT DISTINCT fold_id, hour, is_weekend, from_station AS station_name, rate FROM own),
rates AS (SELECT DISTINCT fold_id, hour, is_weekend, from_station, rate FROM edges)"""


MK = (PREP, folds_sql(1, 1, 7), markov(6))
trip_sql("transition_probs", f"SELECT fold_id, hour, is_weekend, from_station, to_station, {r('prob')}, {r('rate')} FROM edges", *MK)
trip_sql("departure_rates", f"SELECT fold_id, hour, is_weekend, station_name, {r('rate')} FROM own_rates", *MK)
trip_sql("global_transitions", f"SELECT fold_id, from_station, to_station, trips, {r('prob')}, {r('rate')} FROM fallback", *MK)
trip_sql("markov_contexts", "SELECT * FROM contexts", *MK)
trip_sql(
    "context_transitions",
    f"SELECT fold_id, hour, is_weekend, from_station, to_station, {r('prob')}, {r('rate')} FROM edges WHERE hour = 8 AND NOT is_weekend",
    *MK,
)
trip_sql(
    "top_destinations",
    f"""SELECT fold_id, hour, is_weekend, from_station, CAST(rank AS INTEGER) AS rank, to_station AS destination, {r('prob', 'probability')} FROM
    (SELECT *, row_number() OVER (PARTITION BY fold_id, hour, is_weekend, from_station ORDER BY prob DESC, to_station) AS rank FROM edges WHERE prob > 0)
    WHERE rank <= 3""",
    *MK,
)
TOP = """busy AS (SELECT *, row_number() OVER (PARTITION BY fold_id, hour, is_weekend ORDER BY rate DESC, station_name) AS rank FROM own_rates)"""
trip_sql(
    "top_rate_stations",
    f"SELECT fold_id, hour, is_weekend, station_name, {r('rate')}, CAST(rank AS INTEGER) AS rank FROM busy WHERE rank <= 5",
    *MK,
    TOP,
)
trip_sql(
    "route_volumes",
    f"""SELECT t.fold_id, t.hour, t.is_weekend, t.from_station, CAST(t.rank AS INTEGER) AS rank, t.to_station AS destination, {r('t.prob', 'probability')},
    {r('b.rate', 'rate')}, {r('b.rate * t.prob', 'volume')} FROM
    (SELECT *, row_number() OVER (PARTITION BY fold_id, hour, is_weekend, from_station ORDER BY prob DESC, to_station) AS rank FROM own) t
    JOIN busy b ON b.fold_id = t.fold_id AND b.hour = t.hour AND b.is_weekend = t.is_weekend AND b.station_name = t.from_station
    WHERE t.rank <= 5 AND b.rank <= 7""",
    *MK,
    TOP,
)
trip_sql(
    "busy_submatrix",
    f"""SELECT a.fold_id, a.hour, a.is_weekend, a.station_name AS from_station, b.station_name AS to_station,
    CASE WHEN length(a.station_name) > 40 THEN left(a.station_name, 37) || '...' ELSE a.station_name END AS from_label,
    CASE WHEN length(b.station_name) > 40 THEN left(b.station_name, 37) || '...' ELSE b.station_name END AS to_label,
    {r('coalesce(o.prob, 0)', 'prob')}
    FROM busy a JOIN busy b USING (fold_id, hour, is_weekend)
    LEFT JOIN own o ON o.fold_id = a.fold_id AND o.hour = a.hour AND o.is_weekend = a.is_weekend AND o.from_station = a.station_name AND o.to_station = b.station_name
    WHERE a.rank <= 7 AND b.rank <= 7""",
    *MK,
    TOP,
)
trip_sql(
    "residential_stations",
    f"""SELECT fold_id, station_name, {r('morning_rate')}, {r('evening_rate')}, {r('difference')}, CAST(rank AS INTEGER) AS rank FROM
    (SELECT *, row_number() OVER (PARTITION BY fold_id ORDER BY difference DESC, station_name) AS rank FROM
        (SELECT *, morning_rate - evening_rate AS difference FROM
            (SELECT coalesce(m.fold_id, e.fold_id) AS fold_id, coalesce(m.from_station, e.from_station) AS station_name,
                coalesce(m.rate, 0) AS morning_rate, coalesce(e.rate, 0) AS evening_rate
            FROM (SELECT * FROM rates WHERE hour = 8 AND NOT is_weekend) m
            FULL OUTER JOIN (SELECT * FROM rates WHERE hour = 17 AND NOT is_weekend) e ON m.fold_id = e.fold_id AND m.from_station = e.from_station)))
    WHERE rank <= 5""",
    *MK,
)
trip_sql(
    "hourly_activity",
    f"""SELECT fold_id, hour, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, {r('sum(rate)', 'total_trips_per_hour')}
    FROM own_rates GROUP BY fold_id, hour, is_weekend""",
    *MK,
)
NS = "(SELECT count(*) FROM stats)"
trip_sql(
    "context_statistics",
    f"""SELECT fold_id, hour, is_weekend, n_nonzero, {r(f'n_nonzero::DOUBLE / ({NS} * {NS})', 'density')},
    {r(f'1 - n_nonzero::DOUBLE / ({NS} * {NS})', 'sparsity')}, {r(f'total_rate / {NS}', 'avg_rate')}, {r('max_rate')}, {r('total_rate')}
    FROM (SELECT fold_id, hour, is_weekend, count(*) AS n_nonzero FROM own GROUP BY ALL)
    JOIN (SELECT fold_id, hour, is_weekend, sum(rate) AS total_rate, max(rate) AS max_rate FROM own_rates GROUP BY ALL) USING (fold_id, hour, is_weekend)""",
    *MK,
)
trip_sql(
    "markov_report",
    f"""SELECT fold_id, count(*) AS n_transition_matrices, {r(f'avg(1 - n::DOUBLE / ({NS} * {NS}))', 'avg_sparsity')}
    FROM (SELECT fold_id, hour, is_weekend, count(*) AS n FROM own GROUP BY ALL) GROUP BY 1""",
    *MK,
)
trip_sql(
    "net_flow_forecast",
    f"""SELECT g.fold_id, g.station_name, g.ts, {r('coalesce(a.arr, 0) - coalesce(d.rate, 0)', 'net_flow')} FROM
    (SELECT f.fold_id, s.station_name, f.test_start + to_hours(i) AS ts FROM folds f CROSS JOIN stats s CROSS JOIN generate_series(0, 167) q(i)) g
    LEFT JOIN (SELECT fold_id, hour, is_weekend, to_station, sum(prob * rate) AS arr FROM edges GROUP BY ALL) a
        ON a.fold_id = g.fold_id AND a.hour = hour(g.ts) AND a.is_weekend = {WEEKEND.format('g.ts')} AND a.to_station = g.station_name
    LEFT JOIN rates d ON d.fold_id = g.fold_id AND d.hour = hour(g.ts) AND d.is_weekend = {WEEKEND.format('g.ts')} AND d.from_station = g.station_name""",
    *MK,
)


def markov_walk(last: int) -> str:
    """Each step reads the whole previous state: what stays, plus what arrives."""
    return f"""mk_walk AS (SELECT fold_id, station_name, 0 AS i, test_start AS ts, bikes, capacity FROM init
    UNION ALL (WITH nxt AS (SELECT w.fold_id, w.station_name, w.i + 1 AS i, w.ts + INTERVAL 1 HOUR AS ts, w.bikes, w.capacity,
            least(coalesce(d.rate, 0), w.bikes) AS leaving
        FROM mk_walk w LEFT JOIN rates d ON d.fold_id = w.fold_id AND d.hour = hour(w.ts + INTERVAL 1 HOUR)
            AND d.is_weekend = {WEEKEND.format('(w.ts + INTERVAL 1 HOUR)')} AND d.from_station = w.station_name WHERE w.i < {last})
        SELECT fold_id, station_name, i, ts, least(coalesce(max(capacity), 30.0::DOUBLE), greatest(0.0::DOUBLE, sum(m)::DOUBLE / 1e9::DOUBLE)) AS bikes, max(capacity) AS capacity
        FROM (SELECT fold_id, station_name, i, ts, round((bikes - leaving) * 1e9)::BIGINT AS m, capacity FROM nxt
            UNION ALL SELECT n.fold_id, e.to_station, n.i, n.ts, round(e.prob * n.leaving * 1e9)::BIGINT, NULL FROM nxt n JOIN edges e ON e.fold_id = n.fold_id
                AND e.hour = hour(n.ts) AND e.is_weekend = {WEEKEND.format('n.ts')} AND e.from_station = n.station_name)
        GROUP BY fold_id, station_name, i, ts))"""


recursive("forecast_markov", PATH + "mk_walk", *MK, INIT, markov_walk(167))


def ensemble_walk(last: int, simulations: int, seed: int = 42) -> str:
    """Simulated walks: a bike leaves for the destination whose slice of [0, 1) holds its draw."""
    draw = lambda number: f"""(('0x' || substr(md5(concat_ws('|', '{seed}', fold_id, sim_id, station_name, ts, {number})), 1, 13))::BIGINT / {2**52}.0::DOUBLE)"""
    poisson = f"""list_reduce(list_prepend({{'k': 0::BIGINT, 'log': -lam, 'cdf': exp(-lam)}},
            list_transform(range(1, floor(x)::BIGINT + 1), lambda k: {{'k': k, 'log': 0.0::DOUBLE, 'cdf': 0.0::DOUBLE}})),
        lambda a, e: CASE WHEN a.k = e.k - 1 AND u > a.cdf
            THEN {{'k': e.k, 'log': a.log + ln(lam / e.k), 'cdf': a.cdf + exp(a.log + ln(lam / e.k))}} ELSE a END).k"""
    return f"""slices AS MATERIALIZED (SELECT *, coalesce(lag(hi) OVER (PARTITION BY fold_id, hour, is_weekend, from_station ORDER BY to_station), 0) AS lo FROM (
        SELECT fold_id, hour, is_weekend, from_station, to_station, CASE WHEN lead(to_station) OVER o IS NULL THEN 1.0::DOUBLE ELSE sum(prob) OVER o END AS hi
        FROM edges WINDOW o AS (PARTITION BY fold_id, hour, is_weekend, from_station ORDER BY to_station ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))),
known_rates AS MATERIALIZED (SELECT * FROM rates),
en_walk AS (SELECT fold_id, s AS sim_id, station_name, 0 AS i, test_start AS ts, bikes, coalesce(capacity, 30.0::DOUBLE) AS cap FROM init CROSS JOIN generate_series(0, {simulations - 1}) g(s)
    UNION ALL (WITH before AS (SELECT w.fold_id, w.sim_id, w.station_name, w.i + 1 AS i, w.ts + INTERVAL 1 HOUR AS ts, w.bikes AS x, w.cap,
            coalesce(d.rate, 0) * w.bikes / greatest(w.cap, 1) AS lam
        FROM en_walk w LEFT JOIN known_rates d ON d.fold_id = w.fold_id AND d.hour = hour(w.ts + INTERVAL 1 HOUR)
            AND d.is_weekend = {WEEKEND.format('(w.ts + INTERVAL 1 HOUR)')} AND d.from_station = w.station_name WHERE w.i < {last}),
        nxt AS (SELECT *, CASE WHEN lam > 0 AND x >= 1 THEN {poisson} ELSE 0 END AS leaving FROM (SELECT *, {draw(0)} AS u FROM before)),
        gone AS (SELECT *, {draw('j')} AS v FROM (SELECT fold_id, sim_id, station_name, i, ts, unnest(range(1, leaving + 1)) AS j FROM nxt))
        SELECT fold_id, sim_id, station_name, i, ts, least(max(cap), greatest(0.0::DOUBLE, sum(m)::DOUBLE / 1e9::DOUBLE)) AS bikes, max(cap) AS cap
        FROM (SELECT fold_id, sim_id, station_name, i, ts, round((x - leaving) * 1e9)::BIGINT AS m, cap FROM nxt
            UNION ALL SELECT g.fold_id, g.sim_id, e.to_station, g.i, g.ts, 1000000000, NULL FROM gone g JOIN slices e ON e.fold_id = g.fold_id
                AND e.hour = hour(g.ts) AND e.is_weekend = {WEEKEND.format('g.ts')} AND e.from_station = g.station_name AND g.v >= e.lo AND g.v < e.hi)
        GROUP BY fold_id, sim_id, station_name, i, ts))"""


recursive(
    "forecast_ensemble",
    f"""SELECT w.fold_id, w.station_name, {r('any_value(n.capacity)', 'capacity')}, w.ts, {r('avg(w.bikes)', 'mean')},
    {r('quantile_cont(w.bikes, 0.05)', 'lower')}, {r('quantile_cont(w.bikes, 0.95)', 'upper')}
    FROM en_walk w JOIN init n ON n.fold_id = w.fold_id AND n.station_name = w.station_name GROUP BY w.fold_id, w.station_name, w.ts""",
    *MK,
    INIT,
    ensemble_walk(167, 50),
)

# -- comparison ---------------------------------------------------------------

LOWER = "('inventory_mae', 'inventory_rmse')"
KEY8 = "('inventory_mae', 'inventory_rmse', 'correlation', 'empty_recall', 'empty_precision', 'full_recall', 'full_precision', 'state_accuracy')"
KEY10 = "('inventory_mae', 'inventory_rmse', 'correlation', 'empty_recall', 'empty_precision', 'empty_f1', 'full_recall', 'full_precision', 'full_f1', 'state_accuracy')"


def paired(first: str, second: str, keys: str) -> str:
    return f"""paired AS (SELECT a.metric, a.mean AS m1, a.std AS s1, b.mean AS m2, b.std AS s2 FROM summary a JOIN summary b ON a.metric = b.metric
    WHERE a.model = '{first}' AND b.model = '{second}' AND a.metric IN {keys})"""


BETTER = f"CASE WHEN metric IN {LOWER} THEN m1 < m2 ELSE m1 > m2 END"
CMP8 = (*ALL3, SUMMARY, paired("temporal_flow", "persistence", KEY8))
CMP10 = (*ALL3, SUMMARY, paired("station_avg", "temporal_flow", KEY10))
recursive(
    "compare_models",
    f"SELECT metric, {r('m2', 'other_mean')}, {r('m1', 'current_mean')}, {r('m1 - m2', 'delta')}, {BETTER} AS is_better FROM paired",
    *CMP8,
)
recursive("compare_improvements", f"SELECT count(*) FILTER ({BETTER}) AS improved, count(*) AS compared FROM paired", *CMP8)
WINNER = f"CASE WHEN {BETTER} THEN 'station_avg' ELSE 'temporal_flow' END"
recursive(
    "compare_models_pct",
    f"""SELECT metric, {r('m1', 'first_mean')}, {r('s1', 'first_std')}, {r('m2', 'second_mean')}, {r('s2', 'second_std')},
    {r('m2 - m1', 'diff')}, {r('coalesce((m2 - m1) / nullif(m1, 0) * 100, 0)', 'pct_diff')}, {WINNER} AS winner FROM paired""",
    *CMP10,
)
recursive(
    "compare_wins",
    f"""SELECT a AS first_wins, b AS second_wins, CASE WHEN a > b THEN 'station_avg' WHEN b > a THEN 'temporal_flow' ELSE 'Tie' END AS overall_winner
    FROM (SELECT count(*) FILTER ({WINNER} = 'station_avg') AS a, count(*) FILTER ({WINNER} = 'temporal_flow') AS b FROM paired)""",
    *CMP10,
)
recursive(
    "model_advantage",
    f"SELECT metric, {r(f'CASE WHEN metric IN {LOWER} THEN m2 - m1 ELSE m1 - m2 END', 'advantage')} FROM paired",
    *CMP10,
)
recursive(
    "fold_series",
    f"""SELECT fold_id, {r('v1', 'first_value')}, {r('v2', 'second_value')}, {r('v2 - v1', 'diff')},
    CASE WHEN v1 < v2 THEN 'station_avg' ELSE 'temporal_flow' END AS winner, {r('avg(v2 - v1) OVER ()', 'mean_diff')}
    FROM (SELECT a.fold_id, a.inventory_mae AS v1, b.inventory_mae AS v2 FROM metrics a JOIN metrics b ON a.fold_id = b.fold_id
        WHERE a.model = 'station_avg' AND b.model = 'temporal_flow')""",
    *ALL3,
)
recursive(
    "latest_results",
    f"SELECT model, '20240102_000000' AS run_ts, fold_id, {r('inventory_mae')}, {r('state_accuracy')} FROM metrics",
    *ALL3,
)

SWEEP_FOLDS = (
    ",\n".join(folds_sql(t, 1, 7, name=f"f{t}") for t in (1, 2, 3))
    + """,
folds AS ("""
    + " UNION ALL ".join(
        f"SELECT fold_id + {t} * 1000000 AS fold_id, train_start, train_end, test_start, test_end FROM f{t}" for t in (1, 2, 3)
    )
    + ")"
)
CONFIG = "CAST(fold_id // 1000000 AS INTEGER)"
recursive(
    "lookback_sweep",
    f"""SELECT model, CAST(fold_id % 1000000 AS INTEGER) AS fold_id, {metric_columns()}, {DATES}, {CONFIG} AS config_id
    FROM metrics JOIN folds f USING (fold_id)""",
    PREP,
    SWEEP_FOLDS,
    INIT,
    TRUTH,
    markov(6),
    markov_walk(167),
    metric_ctes({"markov": "mk_walk"}),
)
SWEEP5 = ["inventory_mae", "inventory_rmse", "empty_recall", "full_recall", "state_accuracy"]
SWEEP = (
    PREP,
    SWEEP_FOLDS,
    INIT,
    TRUTH,
    FACTS,
    FLOW_FIT,
    FLOW_WALK,
    metric_ctes({"temporal_flow": "flow_walk"}),
    "configs AS ("
    + " UNION ALL ".join(
        f"SELECT {CONFIG} AS config_id, '{m}' AS metric, avg({m}) AS mean, stddev_pop({m}) AS std FROM metrics GROUP BY 1" for m in SWEEP5
    )
    + ")",
)
recursive(
    "normalized_configs",
    f"""SELECT c.config_id, c.metric,
    {r(f'coalesce(CASE WHEN c.metric IN {LOWER} THEN hi - c.mean ELSE c.mean - lo END / nullif(hi - lo, 0), 0.5::DOUBLE)', 'score')},
    {r('coalesce(c.std / nullif(hi - lo, 0), 0::DOUBLE)', 'score_std')}
    FROM configs c JOIN (SELECT metric, min(mean) AS lo, max(mean) AS hi FROM configs GROUP BY 1) b ON b.metric = c.metric""",
    *SWEEP,
)


def best(metric: str, order: str) -> str:
    return f"(SELECT config_id FROM configs WHERE metric = '{metric}' ORDER BY mean {order}, config_id LIMIT 1)"


MAE = "(SELECT avg(mean) FROM configs WHERE metric = 'inventory_mae' AND {})"
recursive(
    "recommend_configs",
    f"""SELECT {best('inventory_mae', 'ASC')} AS lowest_mae_config, {best('empty_recall', 'DESC')} AS best_empty_config,
    {best('full_recall', 'DESC')} AS best_full_config, {best('state_accuracy', 'DESC')} AS best_state_config,
    {r(MAE.format('config_id <= 2'), 'short_train_mae')}, {r(MAE.format('config_id >= 3'), 'long_train_mae')},
    {r(MAE.format('true'), 'one_week_test_mae')}, {r(MAE.format('false'), 'two_week_test_mae')}""",
    *SWEEP,
)
LENGTHS = ((1, 1), (2, 1), (1, 2), (2, 2))
UNTIL_END = "JOIN folds ff ON ff.fold_id = t.fold_id WHERE t.ts + INTERVAL 1 HOUR < ff.test_end"
recursive(
    "recommend_test_lengths",
    f"""SELECT {best('inventory_mae', 'ASC')} AS lowest_mae_config, {best('empty_recall', 'DESC')} AS best_empty_config,
    {best('full_recall', 'DESC')} AS best_full_config, {best('state_accuracy', 'DESC')} AS best_state_config,
    {r(MAE.format('true'), 'short_train_mae')}, {r(MAE.format('false'), 'long_train_mae')},
    {r(MAE.format('config_id <= 2'), 'one_week_test_mae')}, {r(MAE.format('config_id >= 3'), 'two_week_test_mae')}""",
    PREP,
    ",\n".join(folds_sql(train, test, 7, name=f"g{i}") for i, (train, test) in enumerate(LENGTHS, 1))
    + ",\nfolds AS ("
    + " UNION ALL ".join(f"SELECT fold_id + {i} * 1000000 AS fold_id, train_start, train_end, test_start, test_end FROM g{i}" for i in (1, 2, 3, 4))
    + ")",
    INIT,
    TRUTH.replace("WHERE t.i < 167", UNTIL_END),
    FACTS,
    FLOW_FIT,
    FLOW_WALK.replace("WHERE t.i < 167", UNTIL_END),
    *SWEEP[-2:],
)
