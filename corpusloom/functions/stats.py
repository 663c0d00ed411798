"""Statistics with the exact conventions gates are calibrated on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_statistics(df: DataFrame, by: list[str], value: str, picks: dict[str, Callable[[Column], Column]], points: dict[str, float] | None = None) -> DataFrame:
    """by and, for each of ``picks``, the value at index ``pick(n)`` (from 0) of the group's n sorted values, and for each of
    ``points`` (shares of at most four decimals) the percentile by linear interpolation between two of them; nulls left out.

    For groups of any size: value counts come first and are spread over range partitions, so no task holds a group, nor
    its distinct values. A group without values has no row; a null in ``by`` is a group of its own."""
    from corpusloom.operators.intervals import global_running, grouped_running

    points = points or {}
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    rows = grouped_running(counts, by, [value], "_n") if by else global_running(counts, [value], "_n")
    holds = lambda i: (i >= F.col("before")) & (i < F.col("before") + F.col("_n"))
    place = lambda p: F.lit(round(p * 10_000)).cast("long") * (F.col("total") - 1)
    index = {k: f(F.col("total")) for k, f in picks.items()}
    for k, p in points.items():
        index |= {f"_lo_{k}": F.floor(place(p) / 10_000), f"_hi_{k}": F.ceil(place(p) / 10_000)}
    found = rows.groupBy(*by).agg(F.max("total").alias("total"), *(F.max(F.when(holds(i), F.col(value))).alias(k) for k, i in index.items())).where("total > 0")
    share = lambda p: F.pmod(place(p), F.lit(10_000)) / 10_000
    between = [(F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * share(p)).alias(k) for k, p in points.items()]
    return found.select(*by, *picks, *between)


def upper_index(n: Column) -> Column:
    return F.floor(n / 2)


def nearest_index(p: float) -> Callable[[Column], Column]:
    return lambda n: F.bround((n - 1) * F.lit(p))


def percent_below(value: Column, *group: str) -> Column:
    """100 * (rows strictly below) / rows of the group: neither percent_rank nor cume_dist."""
    w = Window.partitionBy(*group)
    return (F.rank().over(w.orderBy(value)) - 1) * 100.0 / F.count("*").over(w)


def percent_below_scaled(df: DataFrame, value: str, group: list[str]) -> DataFrame:
    """``df`` with pct_below, as ``percent_below``, for groups of any size: value counts are spread over range partitions.

    Rows with a null value get null. A null in the group is a group of its own."""
    from corpusloom.operators.intervals import grouped_running

    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    below = grouped_running(counts, group, [value], "_n").select(*group, value, (F.col("before") * 100.0 / F.col("total")).alias("pct_below"))
    same = F.col(f"a.{value}") == F.col(f"b.{value}")
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return df.alias("a").join(below.alias("b"), same, "left").select("a.*", "b.pct_below")


def histogram(df: DataFrame, value: Column, width: float) -> DataFrame:
    """Rows per bin [k * width, (k + 1) * width); nulls left out."""
    return df.select((F.floor(value / width) * width).alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count("*").alias("n"))


def equal_bins(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between least and greatest; the last bin is closed. Empty bins are left out."""
    x = F.col(value)
    ends = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    wide = (F.col("_hi") - F.col("_lo")) / bins
    bin_ = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.floor((x - F.col("_lo")) / wide), F.lit(bins - 1)))
    return df.where(x.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(bin_.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def chrono_parts(df: DataFrame, order: list[str], parts: int, group: list[str]) -> DataFrame:
    """``df`` with part (from 0): rows [d * n // parts, (d + 1) * n // parts) of each group in order; not ntile.

    Groups may be of any size (see ``grouped_running``); ``order`` must be total."""
    from corpusloom.operators.intervals import grouped_running

    rows = grouped_running(df.withColumn("_one", F.lit(1)), group, order, "_one")
    # The d with floor(d n / parts) <= row < floor((d + 1) n / parts) is ceil((row + 1) parts / n) - 1.
    return rows.withColumn("part", (F.ceil((F.col("row") + 1) * parts / F.col("rows")) - 1).cast("int")).drop("_one", "before", "row", "total", "rows")


def topk_share(df: DataFrame, key: str, group: list[str], k: int = 3) -> DataFrame:
    """A5: share of the ``k`` most frequent keys of each group, and how many keys there are; ties by key. Counts come first
    and are ordered over range partitions, so a group may have any number of keys."""
    from corpusloom.operators.intervals import grouped_running

    counts = df.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.count("*").alias("n")).withColumn("_often", -F.col("n"))
    ranked = grouped_running(counts, group, ["_often", key], "n")
    top = F.sum(F.when(F.col("row") < k, F.col("n")))
    return ranked.groupBy(*group).agg(F.sum("n").alias("total"), F.count("*").alias("keys"), top.alias("top"), F.round(top / F.sum("n"), 6).alias("share"))
