"""Selection: splits, samples, budgets and gates. Every draw is a hash of a key, so it is the same on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.intervals import global_running, grouped_running


def hash_unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) from a key: the stand-in for a seeded random draw (same distribution, another draw)."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with row (from 0) and total_rows over one global total order; no task holds all rows."""
    return global_running(df.withColumn("_one", F.lit(1)), order, "_one").drop("before", "total", "_one")


def chronological_split(df: DataFrame, order: list[str], share: float) -> DataFrame:
    """The newest max(1, round(n * share)) rows are 'eval', the others 'train'. ``order`` must be total."""
    k = F.greatest(F.lit(1), F.bround(F.col("total_rows") * F.lit(share)))
    # Only the order keys are sorted; the one row at the edge is broadcast and every row compares itself with it.
    edge = numbered(df.select(*order), order).where(F.col("row") == F.col("total_rows") - k).select(F.struct(*order).alias("_edge"))
    return df.crossJoin(F.broadcast(edge)).withColumn("split", F.when(F.struct(*order) >= F.col("_edge"), "eval").otherwise("train")).drop("_edge")


def even_spread(df: DataFrame, order: list[str], share: float) -> DataFrame:
    """L7: 'eval' is spread evenly: rows round(i * (n - 1) / (k - 1)) for i < k = round(n * share), half to even; k = 1 takes the first."""
    rows = numbered(df, order)
    n = F.col("total_rows")
    k = F.bround(n * F.lit(share))
    step = (n - 1) / (k - 1)
    i = F.bround(F.col("row") / step)  # the only indices that can round to this row are near it
    hits = [F.bround((i + d) * step) == F.col("row") for d in (-1, 0, 1)]
    valid = [((i + d) >= 0) & ((i + d) < k) for d in (-1, 0, 1)]
    inside = (hits[0] & valid[0]) | (hits[1] & valid[1]) | (hits[2] & valid[2])
    chosen = F.when(k < 1, False).when(k == 1, F.col("row") == 0).otherwise(inside | (F.col("row") == n - 1))
    return rows.withColumn("split", F.when(chosen, "eval").otherwise("train")).drop("row", "total_rows")


def stride_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """L2: rows 0, s, 2s, ... with s = max(1, total // n), the first ``n`` of them."""
    s = F.greatest(F.lit(1), F.floor(F.col("total_rows") / n))
    rows = numbered(df, order)
    return rows.where((F.col("row") % s == 0) & (F.col("row") < s * n)).drop("row", "total_rows")


def modulo_split(df: DataFrame, order: list[str], every: int = 10, rest: int = 4) -> DataFrame:
    """Row i is 'eval' if i % every = rest."""
    return numbered(df, order).withColumn("split", F.when(F.col("row") % every == rest, "eval").otherwise("train")).drop("row", "total_rows")


def shuffled_holdout(df: DataFrame, key: str, n: int, seed: int = 3407) -> DataFrame:
    """The ``n`` rows least in hash order are 'eval'; ties by key. Fails, by a row error, if n >= rows."""
    rows = numbered(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), ["_h", key])
    ok = F.assert_true(F.col("total_rows") > n, F.lit("the hold-out takes all rows"))
    return rows.where(ok.isNull()).withColumn("split", F.when(F.col("row") < n, "eval").otherwise("train")).drop("row", "total_rows", "_h")


def round_robin(df: DataFrame, group: str, order: list[str], per_group: int) -> DataFrame:
    """L4: the middle ``per_group`` rows of each group, numbered in turn: first of each group, second of each, ..."""
    rows = grouped_running(df.withColumn("_one", F.lit(1)), [group], order, "_one")
    first = F.greatest(F.lit(0), F.floor((F.col("rows") - per_group) / 2))
    taken = rows.withColumn("turn", (F.col("row") - first).cast("int")).where((F.col("turn") >= 0) & (F.col("turn") < per_group))
    return taken.drop("_one", "before", "row", "total", "rows")


def bucket_targets(df: DataFrame, key: str, buckets: list[tuple[float, float, float]], seed: int = 3407) -> DataFrame:
    """Target per row from weighted buckets (weight, lo, hi): the bucket by weight, the value uniform in it."""
    total = sum(w for w, *_ in buckets)
    u, v = hash_unit(F.col(key), seed), hash_unit(F.col(key), seed + 1)
    out, upto = F.lit(None).cast("double"), 0.0
    edges = []
    for w, lo, hi in buckets:
        upto += w / total
        edges.append((upto, lo + v * (hi - lo)))
    out = edges[-1][1]
    for edge, value in reversed(edges[:-1]):
        out = F.when(u < edge, value).otherwise(out)
    return df.withColumn("target", out)


def mix_report(df: DataFrame, seconds: str, buckets: list[tuple[float, float, float]]) -> DataFrame:
    """How far a corpus is from the designed mix of lengths: for each bucket (weight, lo, hi; lo inclusive) lo, hi, wanted
    (its share of the weights), clips, minutes and share (of the clips in any bucket). A bucket without clips is there too."""
    total = sum(w for w, *_ in buckets)
    plan = df.sparkSession.createDataFrame([(float(lo), float(hi), w / total) for w, lo, hi in buckets], "lo double, hi double, wanted double")
    which = F.lit(None).cast("double")
    for _, lo, hi in buckets:
        which = F.when((F.col(seconds) >= lo) & (F.col(seconds) < hi), F.lit(float(lo))).otherwise(which)
    got = df.select(which.alias("_lo"), F.col(seconds).alias("_s")).where(F.col("_lo").isNotNull()).groupBy("_lo").agg(F.count("*").alias("clips"), (F.sum("_s") / 60).alias("minutes"))
    rows = plan.join(got, F.col("lo") == F.col("_lo"), "left").fillna(0, ["clips"]).fillna(0.0, ["minutes"])  # a row per bucket
    return rows.crossJoin(F.broadcast(got.agg(F.sum("clips").alias("_all")))).select("lo", "hi", "wanted", "clips", "minutes", F.coalesce(F.try_divide("clips", "_all"), F.lit(0.0)).alias("share"))


def budget(df: DataFrame, order: list[str], size: str, need: float) -> DataFrame:
    """Rows in order until ``need`` is reached; the row that crosses it is kept. Too small a pool gives all rows."""
    return global_running(df, order, size).where(F.col("before") < need).drop("before", "total", "row", "total_rows")


def with_percentiles(df: DataFrame, points: dict[str, tuple[str, float]]) -> DataFrame:
    """``df`` with a column for each of ``points``: name to (value column, share), the percentile over the whole table; null
    where no value is known. Each value's counts are ordered over range partitions; one row of results is broadcast."""
    from corpusloom.functions.stats import order_statistics

    per: dict[str, dict[str, float]] = {}
    for name, (value, p) in points.items():
        per.setdefault(value, {})[name] = p
    ends = df.sparkSession.range(1).select(F.lit(0).alias("_one"))
    for value, p in per.items():
        ends = ends.join(F.broadcast(order_statistics(df.select(value), [], value, {}, p).withColumn("_one", F.lit(0))), "_one", "left")
    return df.crossJoin(F.broadcast(ends.drop("_one")))


def percentile_pool(df: DataFrame, bright: str, dyn: str, top: float = 0.995, low: float = 0.1) -> DataFrame:
    """Rows not above the ``top`` percentile of ``bright`` and above the ``low`` one of ``dyn``."""
    rows = with_percentiles(df, {"_b": (bright, top), "_d": (dyn, low)})
    return rows.where((F.col(bright) <= F.col("_b")) & (F.col(dyn) > F.col("_d"))).drop("_b", "_d")


def gate_report(df: DataFrame, masks: dict[str, Column]) -> DataFrame:
    """Rows in, rows each mask rejects, rows any rejects, rows kept. A null mask rejects nothing."""
    no = F.lit(False)
    hit = {k: F.coalesce(m, no) for k, m in masks.items()}
    anyone = no
    for m in hit.values():
        anyone = anyone | m
    return df.agg(F.count("*").alias("rows_in"), *(F.count_if(m).alias(k) for k, m in hit.items()), F.count_if(anyone).alias("rejected"), F.count_if(~anyone).alias("kept"))


def capped_fill(df: DataFrame, low: Column, order: list[str], size: str, cap: float) -> DataFrame:
    """All rows that are not ``low``, and those that are, in order, until their cumulative size has crossed ``cap``."""
    lows = budget(df.where(F.coalesce(low, F.lit(False))), order, size, cap)
    return df.where(~F.coalesce(low, F.lit(False))).unionByName(lows)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """L1: a report of the ``k`` first rows; give a unique last order key."""
    return df.orderBy(*order).limit(k)
