"""Exact percentiles of very large groups, from mergeable value counts and one distributed sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.intervals import ranged
from corpusloom.session import checked_broadcast, materialize

#: The percentiles of the statement: median, 90th, 95th, 99th.
POINTS = (0.5, 0.9, 0.95, 0.99)  # of at most four decimals


def value_counts(df: DataFrame, keys: dict[str, Column], values: dict[str, Column]) -> DataFrame:
    """The mergeable form: metric, the keys, value, n. Counts made apart (by partition, day, ...) add up exactly.

    Null and NaN values are left out; null keys are keys of their own; repeated rows count."""
    metrics = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()))
    rows = df.select(*(c.alias(k) for k, c in keys.items()), F.explode(metrics).alias("x")).select("x.metric", *keys, (F.col("x.value") + 0.0).alias("value"))
    return rows.where("value is not null and not isnan(value)").groupBy("metric", *keys, "value").agg(F.count("*").alias("n"))


def merge_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of several days or parts, or of finer groups, as those of ``keys``."""
    return counts.groupBy("metric", *keys, "value").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, keys: list[str], points: tuple[float, ...] = POINTS) -> DataFrame:
    """metric, keys, n, then p50, p90, ... (linear interpolation between neighbouring order statistics; error 0).

    Method: a range-partitioned sort of the counts over (metric, keys, value), so that a group of any size is spread
    over as many partitions as it needs; running counts in each partition, and counts per (partition, group), give each
    row's place in its group, and rows travel once; rows that cover a target position are picked out and interpolated. A group without values has no row.
    """
    group = ["metric", *keys]
    placed = ranged(counts.select(*group, "value", "n"), [*group, "value"], "n")
    parts = placed.groupBy("_p", *group).agg(F.sum("n").alias("held"), F.min("_before").alias("begins"))
    # A row per partition and group: as range partitions cut a group only at their ends, groups + partitions rows.
    by = Window.partitionBy(*group)
    before = F.coalesce(F.sum("held").over(by.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = materialize(parts.select("_p", *group, (before - F.col("begins")).alias("offset"), F.sum("held").over(by).alias("total")))
    same = [F.col("r._p") == F.col("o._p"), *(F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in group)]
    upto = F.col("_before") + F.col("n") + F.col("offset")
    rows = placed.alias("r").join(checked_broadcast(offsets).alias("o"), on=_all(same)).select(*(f"r.{k}" for k in group), "value", "total", upto.alias("end"), "n")

    targets = [(i, p) for i, p in enumerate(points)]
    lo = lambda p: F.floor(F.lit(round(p * 10_000)).cast("long") * (F.col("total") - 1) / 10_000)
    covers = lambda at: (at >= F.col("end") - F.col("n")) & (at < F.col("end"))
    touched = rows.where(_any([covers(lo(p)) | covers(lo(p) + 1) for _, p in targets]))
    picked = touched.groupBy(*group).agg(
        F.max("total").alias("n"),
        *(F.max(F.when(covers(lo(p)), F.col("value"))).alias(f"lo{i}") for i, p in targets),
        *(F.max(F.when(covers(lo(p) + 1), F.col("value"))).alias(f"hi{i}") for i, p in targets),
    )

    def at(i: int, p: float) -> Column:
        share = F.pmod(F.lit(round(p * 10_000)).cast("long") * (F.col("n") - 1), F.lit(10_000)) / 10_000  # exact
        low, high = F.col(f"lo{i}"), F.coalesce(f"hi{i}", f"lo{i}")
        return F.round(low + (high - low) * share, 6).alias(f"p{100 * p:g}")

    return picked.select(*group, "n", *(at(i, p) for i, p in targets))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def lifetime_percentiles(daily: DataFrame, points: tuple[float, ...] = POINTS) -> DataFrame:
    """Percentiles of lifetime.ctr and lifetime.impressions by (channel, format) and by channel alone.

    Columns: metric, level ('channel_format' or 'channel'), channel, format (null at the level of the channel), n,
    p50, p90, p95, p99. The counts of the finer level are merged to those of the coarser one."""
    keys = {"level": F.lit("channel_format"), "channel": F.col("channel"), "format": F.col("format")}
    fine = value_counts(daily, keys, {"ctr": F.col("lifetime.ctr"), "impressions": F.col("lifetime.impressions")})
    # Each row of the finer counts also counts for its channel; those rows meet their equals of the other formats below.
    levels = F.array(F.struct(F.col("level"), F.col("format")), F.struct(F.lit("channel").alias("level"), F.lit(None).cast("string").alias("format")))
    both = fine.withColumn("l", F.explode(levels)).select("metric", "l.level", "channel", "l.format", "value", "n")
    return percentiles(both, list(keys), points)
