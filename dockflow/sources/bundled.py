"""The bundled tables seen as trips and stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as trips between the stations of ``nation``. One residue in 26
    has no station, which gives unnamed starts and ends."""
    nation = table(spark, sf_dir, "nation")
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", k)
    side = lambda p: nation.select(F.col("n_nationkey").alias(f"{p}_key"), F.col("n_name").alias(f"{p}_name"))
    joined = events.join(side("a"), F.col("a_key") == F.col("user_id") % 26, "left").join(
        side("b"), F.col("b_key") == F.col("k") % 26, "left"
    )
    seconds = F.round(F.col("value") * 60).cast("decimal(18,6)")
    zero = F.lit(0)
    started = F.col("ts")

    def station_id(key: str, residue):
        # `||` keeps a null key null.
        return F.concat(F.lit("S"), F.col(key).cast("string"), F.lit("-"), (residue % 2).cast("string"))

    def lat(key: str):
        return F.when(F.col("k") == 99, F.lit(0.0)).otherwise(F.lit(40.45) + F.col(key) * F.lit(0.02))

    return joined.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.col("event_type").alias("rideable_type"),
        started.alias("started_at"),
        (started + F.make_dt_interval(zero, zero, zero, seconds)).alias("ended_at"),
        F.col("a_name").alias("start_station_name"),
        station_id("a_key", F.col("k")).alias("start_station_id"),
        F.col("b_name").alias("end_station_name"),
        station_id("b_key", F.col("user_id")).alias("end_station_id"),
        lat("a_key").alias("start_lat"),
        (F.lit(-74.2) + F.col("a_key") * F.lit(0.02)).alias("start_lng"),
        lat("b_key").alias("end_lat"),
        (F.lit(-74.2) + F.col("b_key") * F.lit(0.02)).alias("end_lng"),
        F.when(F.col("user_id") % 3 == 0, "casual").otherwise("member").alias("member_casual"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
    )


def nation_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as the station dimension of ``event_trips``: one station has no
    docks, and one (key 5) has no record at all."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").where(key != 5).select(
        F.concat(F.lit("S"), key.cast("string"), F.lit("-0")).alias("station_id"),
        F.col("n_name").alias("name"),
        F.when(key == 3, F.lit(0.0)).otherwise((key * 7 % 31 + 10).cast("double")).alias("capacity"),
        (F.lit(40.45) + key * F.lit(0.02)).alias("lat"),
        (F.lit(-74.2) + key * F.lit(0.02)).alias("lng"),
        F.col("n_regionkey").cast("string").alias("region_id"),
    )


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trips between suppliers: years of data and as many
    stations as suppliers."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    started = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), (F.col("l_quantity").cast("int") % 24), F.lit(0), F.lit(0))
    name = lambda key: F.concat(F.lit("Supplier "), key.cast("string"))
    to_key = F.col("l_partkey") % suppliers
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("rideable_type"),
        started.alias("started_at"),
        (started + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber") * 7, F.lit(0))).alias("ended_at"),
        name(F.col("l_suppkey")).alias("start_station_name"),
        name(to_key).alias("end_station_name"),
        F.when(F.col("l_linestatus") == "O", "casual").otherwise("member").alias("member_casual"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as the station dimension of ``lineitem_trips``."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("station_id"),
        F.concat(F.lit("Supplier "), key.cast("string")).alias("name"),
        (key % 31 + 10).cast("double").alias("capacity"),
        F.col("s_nationkey").cast("string").alias("region_id"),
    )


def supplier_feed(spark: SparkSession, sf_dir: str, chunk: int = 500) -> DataFrame:
    """(region, document): the suppliers as feed documents of at most ``chunk``
    stations. Every third station is also published by the next region, with
    another capacity, so ids repeat across regions."""
    regions = F.array(*[F.lit(r) for r in ("bkn", "man", "que", "jc", "nyc")])
    key = F.col("s_suppkey")
    home = (F.col("s_nationkey") % 5).cast("int")
    copies = F.when(key % 3 == 0, F.array(home, (home + 1) % 5)).otherwise(F.array(home))
    rows = table(spark, sf_dir, "supplier").select("*", F.explode(copies).alias("r"))
    station = F.struct(
        key.cast("string").alias("station_id"),
        F.concat(F.lit("N"), key.cast("string")).alias("short_name"),
        F.col("s_name").alias("name"),
        F.when(key % 10 == 7, F.lit("n/a")).otherwise((key % 31 + 10 + F.col("r")).cast("string")).alias("capacity"),
        (F.lit(40.0) + key % 100 * F.lit(0.01)).cast("string").alias("lat"),
        (F.lit(-74.0) + key % 100 * F.lit(0.01)).cast("string").alias("lon"),
        F.col("s_nationkey").cast("string").alias("region_id"),
        F.lit("classic").alias("station_type"),
        (key % 2 == 0).alias("has_kiosk"),
    )
    documents = rows.groupBy("r", F.floor(key / F.lit(chunk)).alias("c")).agg(F.sort_array(F.collect_list(station)).alias("stations"))
    document = F.to_json(F.struct(F.lit(0).cast("long").alias("last_updated"), F.struct("stations").alias("data")))
    return documents.select(F.get(regions, F.col("r")).alias("region"), "c", document.alias("document"))
