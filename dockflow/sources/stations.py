"""Station records: files, feed documents, projection and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.schema import FEED, STATIONS
from dockflow.session import union_all
from dockflow.sources.trips import exists

# Fixed order of the regions in which a station id is looked for first.
REGIONS = ["bkn", "man", "que", "jc", "nyc"]
KEPT = ["station_id", "name", "short_name", "lat", "lon", "capacity", "region_id"]
NUMERIC = ("capacity", "lat", "lon", "lng")


def read_stations(spark: SparkSession, path: str, data_dir: str | None = None, use_parquet: bool = True) -> DataFrame:
    """Stations from the Parquet sibling of ``path``, else from the data
    folder's ``parquet/stations``, else from the CSV at ``path``. The data folder
    is a relative path's first folder, or the one above an absolute path's own."""
    if use_parquet:
        stem = path.rsplit(".", 1)[0]
        absolute = path.startswith("/") or "://" in path
        root = data_dir or (path.rsplit("/", 2)[0] if absolute else path.split("/")[0])
        for candidate in (f"{stem}.parquet", f"{root}/parquet/stations/station_info.parquet"):
            if exists(spark, candidate):
                return spark.read.parquet(candidate)
    if not exists(spark, path):
        raise FileNotFoundError(f"station file not found: {path}")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in STATIONS.fields])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in STATIONS.fields])


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Feed documents, one per file."""
    return spark.read.schema(FEED).option("multiLine", True).json(path)


def parse_feed(documents: DataFrame, column: str = "document") -> DataFrame:
    """Feed documents held as JSON text."""
    others = [c for c in documents.columns if c != column]
    return documents.select(*others, F.from_json(column, FEED).alias("_feed")).select(*others, "_feed.*")


def feed_stations(feed: DataFrame) -> DataFrame:
    """One typed row per station of a feed, longitude renamed to ``lng``;
    ``position`` is the place in its document."""
    others = [c for c in feed.columns if c not in FEED.fieldNames()]
    rows = feed.select(*others, F.posexplode("data.stations").alias("position", "s"))
    return rows.select(
        *others,
        "position",
        "s.station_id",
        "s.short_name",
        "s.name",
        F.col("s.capacity").try_cast("double").alias("capacity"),
        F.col("s.lat").try_cast("double").alias("lat"),
        F.col("s.lon").try_cast("double").alias("lng"),
        "s.region_id",
        "s.station_type",
        "s.has_kiosk",
    )


def union_regions(feeds: dict[str, DataFrame]) -> DataFrame:
    """Station rows of several regional feeds, tagged with their region."""
    return union_all(*[rows.withColumn("region", F.lit(region)) for region, rows in feeds.items()])


def first_per_id(stations: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """One row per station id: that of the first region, then the first position."""
    rank = F.array_position(F.array(*[F.lit(r) for r in (regions or REGIONS)]), F.col("region"))
    order = Window.partitionBy("station_id").orderBy(F.when(rank > 0, rank).otherwise(F.lit(10**6)), "region", "position")
    return stations.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == 1).drop("nth")


def typed_stations(stations: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The wanted columns that exist; ids as text, numbers coerced."""
    columns = [c for c in (keep or KEPT) if c in stations.columns]

    def typed(c: str):
        if c == "station_id":
            return F.col(c).cast("string").alias(c)
        return F.col(c).try_cast("double").alias(c) if c in NUMERIC else F.col(c)

    return stations.select(*[typed(c) for c in columns])


def write_stations(stations: DataFrame, path: str, compression: str = "snappy") -> None:
    stations.write.mode("overwrite").option("compression", compression).parquet(path)


def station_summary(stations: DataFrame) -> DataFrame:
    c = F.col("capacity")
    return stations.agg(
        F.count(F.lit(1)).alias("total_stations"),
        F.sum(c).alias("total_capacity"),
        F.avg(c).alias("avg_capacity"),
        F.min(c).alias("min_capacity"),
        F.max(c).alias("max_capacity"),
        F.count_if(c.isNull()).alias("missing_capacity"),
    )


def stations_per_region(stations: DataFrame) -> DataFrame:
    return stations.groupBy("region_id").agg(F.count(F.lit(1)).alias("stations"))
