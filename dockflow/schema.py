"""Fixed schemas. Station ids are strings: they mix numbers and prefixed codes."""

from pyspark.sql import types as T

TRIP_FIELDS = [
    ("ride_id", T.StringType()),
    ("rideable_type", T.StringType()),
    ("started_at", T.TimestampNTZType()),
    ("ended_at", T.TimestampNTZType()),
    ("start_station_name", T.StringType()),
    ("start_station_id", T.StringType()),
    ("end_station_name", T.StringType()),
    ("end_station_id", T.StringType()),
    ("start_lat", T.DoubleType()),
    ("start_lng", T.DoubleType()),
    ("end_lat", T.DoubleType()),
    ("end_lng", T.DoubleType()),
    ("member_casual", T.StringType()),
]
TRIPS = T.StructType([T.StructField(n, t) for n, t in TRIP_FIELDS])
TRIPS_PARTITIONED = T.StructType(
    TRIPS.fields + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)

STATIONS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("short_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("capacity", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("station_type", T.StringType()),
        T.StructField("has_kiosk", T.BooleanType()),
    ]
)

# The document a station feed publishes: {"last_updated": …, "data": {"stations": […]}}.
# Capacities and coordinates are read as text and coerced later, since feeds
# disagree on their types.
FEED = T.StructType(
    [
        T.StructField("last_updated", T.LongType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "stations",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("station_id", T.StringType()),
                                    T.StructField("short_name", T.StringType()),
                                    T.StructField("name", T.StringType()),
                                    T.StructField("capacity", T.StringType()),
                                    T.StructField("lat", T.StringType()),
                                    T.StructField("lon", T.StringType()),
                                    T.StructField("region_id", T.StringType()),
                                    T.StructField("station_type", T.StringType()),
                                    T.StructField("has_kiosk", T.BooleanType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)
