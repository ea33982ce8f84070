"""Small trip tables for tests."""

import numpy as np
import pandas as pd


def random_trips(seed: int, n: int, stations: list[str], days: int, start: str = "2025-09-01") -> pd.DataFrame:
    """Whole-hour starts and uniform stations."""
    rng = np.random.RandomState(seed)
    hours = rng.randint(0, 24 * days, n)
    started = pd.Timestamp(start) + pd.to_timedelta(hours, unit="h")
    return pd.DataFrame(
        {
            "started_at": started,
            "ended_at": started + pd.Timedelta(minutes=30),
            "start_station_name": rng.choice(stations, n),
            "end_station_name": rng.choice(stations, n),
        }
    )


TRIP_DDL = "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_name string, end_station_name string"


def as_trips(spark, pdf: pd.DataFrame):
    rows = [
        (
            a.to_pydatetime(),
            b.to_pydatetime(),
            None if s is None or s != s else str(s),
            None if e is None or e != e else str(e),
        )
        for a, b, s, e in pdf[["started_at", "ended_at", "start_station_name", "end_station_name"]].itertuples(index=False)
    ]
    return spark.createDataFrame(rows, TRIP_DDL)
