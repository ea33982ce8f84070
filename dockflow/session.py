"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "dockflow", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for cut lineage, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would vanish with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="dockflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends here and survives executor loss."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def resident(df: DataFrame) -> DataFrame:
    """A table bounded by the calendar (one row per fold, or a few) as a local
    relation: later plans see its exact size and run no job for it."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def union_all(*tables: DataFrame) -> DataFrame:
    """Union by name.

    Spark 4.1 lets a union keep its inputs' hash partitioning, but adaptive
    coalescing may then change the inputs one by one: a join above it fails with
    "can't zip RDDs with unequal numbers of partitions". The union therefore
    promises no partitioning here.
    """
    tables[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A session setting for the plans made inside; ``None`` leaves it alone."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None:
            if before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

