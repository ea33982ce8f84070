"""Stored cross-validation results and month inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.operators.evaluate import METRICS

_STAT = T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())])
_FOLD = T.StructType(
    [T.StructField(m, T.DoubleType()) for m in METRICS]
    + [
        T.StructField("fold_id", T.IntegerType()),
        T.StructField("train_start", T.StringType()),
        T.StructField("test_start", T.StringType()),
    ]
)
RESULT_DOCUMENT = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("fold_results", T.ArrayType(_FOLD)),
        T.StructField("summary", T.StructType([T.StructField(m, _STAT) for m in METRICS])),
        T.StructField("timestamp", T.StringType()),
        T.StructField("random_seed", T.IntegerType()),
    ]
)


def stamped(df: DataFrame, run_ts: str, config: str | None = None, seed: int | None = None) -> DataFrame:
    """A result table with the run it belongs to."""
    return df.withColumns(
        {
            "run_ts": F.lit(run_ts),
            "config": F.lit(config).cast("string"),
            "random_seed": F.lit(seed).cast("int"),
        }
    )


def append_results(df: DataFrame, path: str) -> None:
    """Append stamped rows, partitioned by model; a run adds a few rows."""
    df.coalesce(1).write.mode("append").partitionBy("model").parquet(path)


def latest_per_model(results: DataFrame) -> DataFrame:
    """The rows of each model's latest run."""
    newest = results.groupBy(F.col("model").alias("of_model")).agg(F.max("run_ts").alias("newest"))
    same = F.col("model").eqNullSafe(F.col("of_model")) & F.col("run_ts").eqNullSafe(F.col("newest"))
    return results.join(newest, same, "left_semi")


def read_result_documents(spark: SparkSession, path: str) -> DataFrame:
    """Result documents (model, fold_results, summary, timestamp), one per file."""
    docs = spark.read.schema(RESULT_DOCUMENT).option("multiLine", True).json(path)
    return docs.withColumn("file", F.col("_metadata.file_path"))


def write_documents(metrics: DataFrame, summary: DataFrame, path: str, run_ts: str, seed: int | None = None) -> None:
    """One JSON document per model (fold_results, summary, timestamp, seed) below
    ``path/run_ts``. A document holds a model's folds, as many as the calendar has."""
    fold = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _FOLD.fields])
    stat = lambda m: F.max(F.when(F.col("metric") == m, F.struct("mean", "std"))).alias(m)
    folds = metrics.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("fold_id", fold.alias("f")))).alias("folds"))
    means = summary.groupBy("model").agg(*[stat(m) for m in METRICS]).select("model", F.struct(*METRICS).alias("summary"))
    documents = folds.join(means, "model").select(
        "model",
        F.col("folds")["f"].alias("fold_results"),
        "summary",
        F.lit(run_ts).alias("timestamp"),
        F.lit(seed).cast("int").alias("random_seed"),
    )
    documents.repartition("model").write.mode("overwrite").option("maxRecordsPerFile", 1).json(f"{path}/{run_ts}")


def latest_documents(documents: DataFrame) -> DataFrame:
    """Per model the document whose file sorts last."""
    newest = Window.partitionBy("model").orderBy(F.desc("file"))
    return documents.withColumn("nth", F.row_number().over(newest)).where(F.col("nth") == 1).drop("nth")


def document_summary(documents: DataFrame) -> DataFrame:
    """(model, metric, mean, std)."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.col(f"summary.{m}.mean").alias("mean"), F.col(f"summary.{m}.std").alias("std")
            )
            for m in METRICS
        ]
    )
    return documents.select("model", F.inline(cells)).where(F.col("mean").isNotNull())


def document_folds(documents: DataFrame) -> DataFrame:
    """(model, fold metrics …), one row per fold."""
    return documents.select("model", F.inline("fold_results"))


def write_month_inventory(inventory: DataFrame, path: str) -> None:
    """Start and end inventories as CSV and Parquet, one folder per month."""
    rows = inventory.hint("rebalance", "year", "month")
    rows.write.mode("overwrite").partitionBy("year", "month").parquet(f"{path}/month_inventory")
    for side in ("start", "end"):
        rows.select("year", "month", "station_name", F.col(f"{side}_bikes").alias("bikes")).write.mode(
            "overwrite"
        ).option("header", True).partitionBy("year", "month").csv(f"{path}/{side}_inventory")


def write_month_documents(inventory: DataFrame, path: str) -> None:
    """One JSON document per month: its stations with both inventories, by name.
    A month has as many stations as the network."""
    station = F.struct("station_name", "start_bikes", "end_bikes")
    months = inventory.groupBy("year", "month").agg(F.sort_array(F.collect_list(station)).alias("stations"))
    months.write.mode("overwrite").partitionBy("year", "month").json(f"{path}/month_documents")


def write_month_summary(summary: DataFrame, path: str) -> None:
    """One JSON row per month."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/inventory_summary")
