"""Exact quantiles of a large column.

Spark's exact percentile gathers every distinct value in one task. Here values
are counted first, and the counted values are written once. Rounds then cut the
span that holds a wanted rank at approximate quantiles of its distinct values and
keep the piece that holds the rank, until a span has few enough values to be
ordered in one task. Cuts follow the values' ranks, not their sizes, so a round
leaves about a 256th of a span however the values lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockflow.functions.numeric import position_sql
from dockflow.session import cut

#: Distinct values that are ordered in one task, and pieces a round makes of a span.
_FEW, _PIECES = 10_000, 256


class _Span(NamedTuple):
    """Values from ``low`` to ``high``, both included, with ``before`` rows below
    and ``distinct`` values inside."""

    low: float
    high: float
    before: int
    distinct: int


def _within(hist: DataFrame, spans: list[_Span]) -> DataFrame:
    """Counted values inside the spans, tagged with the span's number."""
    listed = F.array(*[F.struct(F.lit(i).alias("span"), F.lit(s.low).alias("low"), F.lit(s.high).alias("high")) for i, s in enumerate(spans)])
    value = F.col("value")
    # The spans' number is twice that of the quantiles at most; the outer bounds reach the scan.
    outer = (value >= min(s.low for s in spans)) & (value <= max(s.high for s in spans))
    return hist.where(outer).select("value", "n", F.inline(listed)).where((value >= F.col("low")) & (value <= F.col("high")))


def _pieces(hist: DataFrame, spans: list[_Span]) -> dict[int, list[_Span]]:
    """Each span cut at approximate quantiles of its distinct values."""
    shares = F.array(*[F.lit(i / _PIECES) for i in range(1, _PIECES)])
    approximate = F.percentile_approx("value", shares, F.lit(8 * _PIECES)).alias("points")
    found = _within(hist, spans).groupBy("span").agg(approximate).collect()
    points = F.array(*[F.array(*[F.lit(p) for p in sorted(set(r["points"]))]) for r in sorted(found, key=lambda r: r["span"])])
    piece = F.expr(position_sql("points", "value"))
    counted = (
        _within(hist, spans)
        .withColumn("points", F.get(points, F.col("span")))
        .groupBy("span", piece.alias("piece"))
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"))
    )
    out: dict[int, list[_Span]] = {}
    before = [s.before for s in spans]
    for r in sorted(counted.collect(), key=lambda r: (r["span"], r["piece"])):  # a few hundred rows a span
        out.setdefault(r["span"], []).append(_Span(r["low"], r["high"], before[r["span"]], r["distinct"]))
        before[r["span"]] += r["n"]
    return out


def spans_of_ranks(hist: DataFrame, ranks: Sequence[int], few: int = _FEW) -> tuple[dict[int, _Span], int]:
    """The span of few distinct values around each rank, and the rounds it took."""
    whole = hist.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("distinct")).first()
    at = dict.fromkeys(ranks, _Span(whole["low"], whole["high"], 0, whole["distinct"]))
    rounds = 0
    while True:
        wide = sorted({s for s in at.values() if s.distinct > few})
        if not wide:
            return at, rounds
        rounds += 1
        pieces = _pieces(hist, wide)
        for rank, span in at.items():
            if span in wide:
                at[rank] = [p for p in pieces[wide.index(span)] if p.before <= rank][-1]


def _values_at(hist: DataFrame, at: dict[int, _Span]) -> dict[int, float]:
    """The values at the ranks; each span is ordered in one task."""
    spans = sorted(set(at.values()))
    before = F.get(F.array(*[F.lit(s.before).cast("long") for s in spans]), F.col("span"))
    run = Window.partitionBy("span").orderBy("value")
    ranked = _within(hist, spans).withColumn("upto", before + F.sum("n").over(run))
    wanted = F.array(*[F.lit(int(r)).cast("long") for r in sorted(at)])
    held = ranked.select("span", "value", "n", "upto", F.explode(wanted).alias("rank")).where(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    )
    return {r["rank"]: r["value"] for r in held.select("rank", "value").collect()}


def exact_quantiles(df: DataFrame, value: Column, probs: Sequence[float]) -> DataFrame:
    """(prob, quantile) with linear interpolation between the two ranks around
    ``prob * (n - 1)``. Nulls are left out; no values give no rows. Runs its
    jobs at once: how many rounds there are depends on the values."""
    spark: SparkSession = df.sparkSession
    hist = cut(
        df.select(value.cast("double").alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    total = hist.agg(F.sum("n")).first()[0]
    schema = "prob double, quantile double"
    if not total:
        return spark.createDataFrame([], schema)
    positions = {float(p): float(p) * (total - 1) for p in probs}
    ranks = sorted({r for x in positions.values() for r in (int(x // 1), int(-(-x // 1)))})
    at = _values_at(hist, spans_of_ranks(hist, ranks)[0])
    rows = [(p, at[int(x // 1)] + (at[int(-(-x // 1))] - at[int(x // 1)]) * (x - x // 1)) for p, x in positions.items()]
    return spark.createDataFrame(rows, schema)
