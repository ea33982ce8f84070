"""Registered queries against their SQL on the small tables. The slow ones are
left to ``tests/compare.py``."""

import pytest
from compare import difference, oracle_frame

from __spark_entry__ import entry, oracle_sql, queries
from dockflow.oracles import ORACLES
from dockflow.queries import QUERIES

SF = "/root/testdata/sf0.001"
CHOSEN = [
    "station_net_flow",
    "trip_stats",
    "trips_by_station",
    "aggregate_trips",
    "query_filter_limit",
    "hour_dow_matrix",
    "type_shares",
    "route_count_describe",
    "route_pareto",
    "supplier_od_pareto",
    "route_cdf",
    "topn_transition_probs",
    "station_coords",
    "null_census",
    "duration_describe",
    "network_summary",
    "hourly_od_summary",
    "flow_by_quarter_hour",
    "trips_per_capacity",
    "feed_dedupe",
    "station_stats",
    "month_inventory",
    "supplier_month_inventory",
    "cv_folds",
    "running_inventory",
]


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_oracle(spark, name):
    mine = queries()[name](spark, SF).toPandas()
    assert difference(mine, oracle_frame(oracle_sql()[name], SF)) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0
