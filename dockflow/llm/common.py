"""What the corpus operators share: tables, the learning split, scratch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.session import cut

__all__ = ["cut", "held_out", "read_table", "text_groups", "over_texts"]

#: Bytes of text that one vectorised step takes at once; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows that no model may learn from; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def text_groups(sizes: list[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def over_texts(docs: DataFrame, columns: list[str], fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over Arrow batches of the chosen columns only, so that other
    columns of ``docs`` never reach Python, whatever their names."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return docs.select(*columns).mapInArrow(run, schema)
