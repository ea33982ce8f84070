"""Trip records: partitioned Parquet, monthly CSV parts, conversion between them."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions.text import month_in_path
from dockflow.functions.time import started_between
from dockflow.schema import TRIPS, TRIPS_PARTITIONED
from dockflow.session import cut, union_all

_HEADER_READERS = 32
#: Folder beside the month folders; readers pass over names that begin so.
MANIFEST = "_manifest"
_MANIFEST_FIELDS = "file string, first timestamp_ntz, last timestamp_ntz, rows long, bytes long, year int, month int"
#: Rows of a row group and of a file.
ROW_GROUP_ROWS, FILE_ROWS = 100_000, 5_000_000


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) exists on its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def _month_bounds(start: str | None, end: str | None) -> Column:
    """The month partitions a date range touches. The time filter alone would
    read the footers of every month."""
    stamp = F.col("year") * 100 + F.col("month")
    cond = F.lit(True)
    if start:
        cond = cond & (stamp >= int(start[:4]) * 100 + int(start[5:7]))
    if end:
        cond = cond & (stamp <= int(end[:4]) * 100 + int(end[5:7]))
    return cond


def read_trips_parquet(
    spark: SparkSession,
    root: str,
    start: str | None = None,
    end: str | None = None,
    whole_end_day: bool = False,
    filed_by_start: bool = False,
) -> DataFrame:
    """Trips under ``year=/month=`` folders.

    Folders are named after the CSV part, which may hold trips that began in
    another month, so folder names say nothing about a range. The manifest that
    conversion writes does: files whose least and greatest start lie outside
    are not opened, files it doesn't know are. Without a manifest the range is
    left to the row groups' statistics; callers who then know that each trip lies
    in the folder of its start say so with ``filed_by_start``.
    """
    whole = spark.read.schema(TRIPS_PARTITIONED).parquet(root)
    in_range = started_between(start, end, whole_end_day)
    if not (start or end):
        return whole
    if filed_by_start:
        return whole.where(_month_bounds(start, end)).where(in_range)
    if exists(spark, f"{root}/{MANIFEST}"):
        apart = _files_apart(spark, root, start, end, whole_end_day)
        files = whole.inputFiles()
        wanted = [f for f in files if "/".join(unquote(f).rsplit("/", 3)[-3:]) not in apart]
        if wanted and len(wanted) < len(files):
            whole = spark.read.schema(TRIPS_PARTITIONED).option("basePath", root).parquet(*[unquote(f) for f in wanted])
        elif not wanted:
            whole = whole.where(F.lit(False))
    return whole.where(in_range)


def _files_apart(spark: SparkSession, root: str, start: str | None, end: str | None, whole_end_day: bool) -> set[str]:
    """The files in the manifest, as ``year=/month=/name``, that hold no start in the range."""
    known = spark.read.schema(_MANIFEST_FIELDS).parquet(f"{root}/{MANIFEST}")
    # A file reaches into the range if its last start isn't before it, nor its first one behind it.
    reaches = started_between(start, None, ts="last") & started_between(None, end, whole_end_day, ts="first")
    # A task names its files alike in all months.
    apart = known.where(~F.coalesce(reaches, F.lit(False))).select("year", "month", "file")
    return {f"year={r['year']}/month={r['month']}/{r['file']}" for r in apart.collect()}  # no more than the driver lists for the scan


def write_manifest(spark: SparkSession, root: str, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Write and return (file, first, last, rows, bytes, year, month) of the
    trip files below ``root``, of the given months only if there are any. One
    pass over the start column. Entries are added to those of earlier
    conversions: no two files of a month ever share a name, and entries of files
    that have been replaced mean nothing."""
    trips = spark.read.schema(TRIPS_PARTITIONED).parquet(root)
    if months is not None:
        trips = trips.where((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months]))
    source = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")]
    entries = cut(
        trips.groupBy("year", "month", *source)
        .agg(F.min("started_at").alias("first"), F.max("started_at").alias("last"), F.count(F.lit(1)).alias("rows"))
        .select("file", "first", "last", "rows", "bytes", "year", "month")
    )
    entries.write.mode("append").parquet(f"{root}/{MANIFEST}")
    return entries


def csv_files(spark: SparkSession, root: str, glob: str) -> list[str]:
    """Paths of the CSV parts below ``root``."""
    listing = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    try:
        files = listing.load(root).inputFiles()
    except AnalysisException as e:
        raise FileNotFoundError(f"no trip data files in {root}") from e
    if not files:
        raise FileNotFoundError(f"no trip data files in {root}")
    return sorted(unquote(f) for f in files)


class CsvPart(NamedTuple):
    path: str
    header: tuple[str, ...]
    size: int


def _part(spark: SparkSession, path: str) -> CsvPart:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(hadoop_path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return CsvPart(path, tuple(next(csv.reader([line.lstrip("\ufeff")]), [])), fs.getFileStatus(hadoop_path).getLen())


def csv_parts(spark: SparkSession, files: list[str]) -> list[CsvPart]:
    """Header and size of each file. Only the first line is looked at here."""
    with ThreadPoolExecutor(_HEADER_READERS) as readers:
        return list(readers.map(lambda f: _part(spark, f), files))


def _raw_csv(spark: SparkSession, found: list[CsvPart]) -> DataFrame:
    """The trip columns of CSV parts as text, matched by header name.

    Spark matches CSV columns by position, so parts are read per distinct
    header (one group as a rule) and united by name; columns a part lacks are
    null.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for part in found:
        layouts.setdefault(part.header, []).append(part.path)
    wanted = [f.name for f in TRIPS.fields]
    parts = []
    for header, paths in layouts.items():
        text = T.StructType([T.StructField(name, T.StringType()) for name in header])
        reader = spark.read.schema(text).option("header", True).option("enforceSchema", False)
        part = reader.option("recursiveFileLookup", True).csv(paths)
        columns = [F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in wanted]
        source = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_bytes")]
        parts.append(part.select(*columns, *source))
    return union_all(*parts)


def typed_trips(raw: DataFrame) -> DataFrame:
    """Text columns cast to the trip schema; unparsable values become null."""
    kinds = {f.name: f.dataType for f in TRIPS.fields}
    return raw.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in raw.columns])


def read_trips_csv(
    spark: SparkSession,
    root: str,
    start: str | None = None,
    end: str | None = None,
    whole_end_day: bool = False,
    glob: str = "202*.csv",
) -> DataFrame:
    """All CSV parts below ``root``."""
    raw = _raw_csv(spark, csv_parts(spark, csv_files(spark, root, glob))).drop("_path", "_bytes")
    return typed_trips(raw).where(started_between(start, end, whole_end_day))


def read_trips(
    spark: SparkSession, data_dir: str, start: str | None = None, end: str | None = None, use_parquet: bool = True, glob: str = "202*.csv"
) -> DataFrame:
    """The Parquet dataset of a data folder if there is one, else its CSV files."""
    root = f"{data_dir}/parquet/trips"
    if use_parquet and exists(spark, root):
        return read_trips_parquet(spark, root, start, end)
    return read_trips_csv(spark, data_dir, start, end, glob=glob)


def monthly_files(spark: SparkSession, root: str, glob: str = "*.csv", first_months: int | None = None) -> dict[str, tuple[int, int]]:
    """(year, month) of the CSV parts below ``root`` whose names have them;
    ``first_months`` keeps the earliest n. The names alone decide."""
    named = spark.createDataFrame([(f,) for f in csv_files(spark, root, glob)], "path string")
    year, month = month_in_path("path")
    rows = named.select("path", year.alias("year"), month.alias("month")).where("year IS NOT NULL AND month IS NOT NULL").collect()
    kept = sorted({(r["year"], r["month"]) for r in rows})[: first_months or None]
    return {r["path"]: (r["year"], r["month"]) for r in rows if (r["year"], r["month"]) in kept}


def _monthly_rows(spark: SparkSession, parts: list[CsvPart]) -> DataFrame:
    year, month = month_in_path("_path")
    return typed_trips(_raw_csv(spark, parts).withColumns({"year": year, "month": month}))


def read_monthly_csv(spark: SparkSession, root: str, glob: str = "*.csv", first_months: int | None = None) -> DataFrame:
    """CSV parts with the year and month found in their names; parts of one
    month are simply rows of that month. ``first_months`` keeps the earliest n."""
    files = monthly_files(spark, root, glob, first_months)
    if not files:
        raise FileNotFoundError(f"no file names with a month in {root}")
    return _monthly_rows(spark, csv_parts(spark, sorted(files)))


def convert_to_parquet(
    trips: DataFrame, target: str, compression: str = "zstd", row_group_rows: int = ROW_GROUP_ROWS, file_rows: int = FILE_ROWS
) -> None:
    """Write monthly CSV rows as ``year=/month=`` Parquet, replacing exactly the
    months present. A split belongs to one part, hence one month, so nothing is
    shuffled and no month has to fit one task. A month gets a file for each split
    of its parts, of at most ``file_rows`` rows in groups of ``row_group_rows``."""
    (
        trips.drop("_path", "_bytes")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", file_rows)
        .option("parquet.block.row.count.limit", row_group_rows)
        .partitionBy("year", "month")
        .parquet(target)
    )


def convert_observed(spark: SparkSession, csv_root: str, target: str, glob: str = "*.csv", first_months: int | None = None) -> DataFrame:
    """Convert the monthly CSV parts and return the audit per month.

    The parts are parsed once: their rows, and those whose start can't be read,
    are counted by an observation of the write itself, per month as the file
    names have them. Rows and bytes written come from the manifest.
    """
    files = monthly_files(spark, csv_root, glob, first_months)
    if not files:
        raise FileNotFoundError(f"no file names with a month in {csv_root}")
    parts = csv_parts(spark, sorted(files))
    months = sorted(set(files.values()))
    seen = Observation("conversion")
    counts = []
    for y, m in months:
        here = (F.col("year") == y) & (F.col("month") == m)
        counts += [F.count_if(here).alias(f"rows_{y}_{m}"), F.count_if(here & F.col("started_at").isNull()).alias(f"bad_{y}_{m}")]
    convert_to_parquet(_monthly_rows(spark, parts).observe(seen, *counts), target)
    found, mb = seen.get, 1024.0 * 1024.0
    rows = []
    for y, m in months:
        own = [p.size for p in parts if files[p.path] == (y, m)]
        rows.append((y, m, len(own), found[f"rows_{y}_{m}"], found[f"bad_{y}_{m}"], sum(own) / mb))
    source = spark.createDataFrame(rows, "year int, month int, parts long, csv_rows long, unread_starts long, csv_mb double")
    written = write_manifest(spark, target, months).groupBy("year", "month").agg(
        F.sum("rows").alias("parquet_rows"), (F.sum("bytes") / F.lit(mb)).alias("parquet_mb")
    )
    return _audited(source.join(written, ["year", "month"], "left"), "unread_starts")


def _audited(months: DataFrame, *more: str) -> DataFrame:
    return months.select(
        "year",
        "month",
        "parts",
        "csv_rows",
        F.coalesce("parquet_rows", F.lit(0).cast("long")).alias("parquet_rows"),
        "csv_mb",
        "parquet_mb",
        F.try_divide("csv_mb", "parquet_mb").alias("compression_ratio"),
        F.coalesce(F.col("csv_rows") == F.col("parquet_rows"), F.lit(False)).alias("success"),
        *more,
    )


def conversion_audit(trips: DataFrame, target: str) -> DataFrame:
    """Per month: rows in the CSV parts and in the written Parquet, both sizes,
    their ratio, and whether the rows agree, counted anew from both; see
    ``convert_observed`` for an audit without a second reading."""
    spark = trips.sparkSession
    mb = F.lit(1024.0 * 1024.0)
    parts = trips.groupBy("year", "month", "_path", "_bytes").agg(F.count(F.lit(1)).alias("rows"))
    source = parts.groupBy("year", "month").agg(
        F.sum("rows").alias("csv_rows"), (F.sum("_bytes") / mb).alias("csv_mb"), F.count(F.lit(1)).alias("parts")
    )
    files = (
        spark.read.schema(TRIPS_PARTITIONED)
        .parquet(target)
        .groupBy("year", "month", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    written = files.groupBy("year", "month").agg(F.sum("rows").alias("parquet_rows"), (F.sum("b") / mb).alias("parquet_mb"))
    return _audited(source.join(written, ["year", "month"], "left"))


def audit_totals(audit: DataFrame) -> DataFrame:
    ok = F.col("success")
    return audit.agg(
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.col("csv_rows"))).alias("total_rows"),
        F.sum(F.when(ok, F.col("parquet_mb"))).alias("total_parquet_mb"),
        F.avg(F.when(ok, F.col("compression_ratio"))).alias("avg_compression"),
    )


def unified_view(spark: SparkSession, months: dict[tuple[int, int], DataFrame], name: str = "trips") -> DataFrame:
    """UNION ALL of monthly tables with year and month columns, as a view;
    columns missing from a month are null."""
    parts = [
        df.withColumns({"year": F.lit(year), "month": F.lit(month)}) for (year, month), df in sorted(months.items())
    ]
    whole = union_all(*parts)
    whole.createOrReplaceTempView(name)
    return whole


def export_parquet(
    df: DataFrame, path: str, partition_cols: tuple[str, ...] = (), compression: str = "zstd"
) -> None:
    """Write Parquet, optionally partitioned. Rows are gathered by partition
    with a rebalance, which splits a partition that is too large for one task."""
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


def write_hourly_summary(summary: DataFrame, path: str) -> None:
    """Materialise the hourly summary in key order (a range-partitioned sort)."""
    keys = ["hour", "start_station_name", "end_station_name"]
    summary.orderBy(*[F.asc_nulls_last(k) for k in keys]).write.mode("overwrite").option("compression", "zstd").parquet(path)
