import math
import random
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm.quantiles import lifetime_percentiles, merge_counts, percentiles, value_counts

def keys():
    return {"channel": F.col("channel"), "format": F.col("format")}


NAMES = ["channel", "format"]


def rows(n=4000, seed=3):
    r = random.Random(seed)
    hot = lambda: r.choice(["hot"] * 3 + ["a", "b", None])
    return [(hot(), r.choice(["long", "short", None]), r.choice([None, r.random(), round(r.random(), 1), 1e9]), date(2024, 1, 1 + i % 5)) for i in range(n)]


def brute(data):
    groups = {}
    for c, f, v, _ in data:
        if v is not None:
            groups.setdefault((c, f), []).append(v)
    return {k: (len(v), *(round(float(np.percentile(v, p)), 4) for p in (50, 90, 95, 99))) for k, v in groups.items()}


def test_exact_against_brute_force_with_ties_and_a_hot_group(spark):
    data = rows()
    df = spark.createDataFrame(data, "channel string, format string, v double, day date").repartition(7)
    got = percentiles(value_counts(df, keys(), {"v": F.col("v")}), NAMES).collect()
    assert {(r.channel, r.format): (r.n, *(round(x, 4) for x in (r.p50, r.p90, r.p95, r.p99))) for r in got} == brute(data)


def test_days_combine(spark):
    data = rows(500)
    df = spark.createDataFrame(data, "channel string, format string, v double, day date")
    daily = value_counts(df, keys() | {"day": F.col("day")}, {"v": F.col("v")})
    a = sorted(percentiles(merge_counts(daily, NAMES), NAMES).collect(), key=str)
    assert a == sorted(percentiles(value_counts(df, keys(), {"v": F.col("v")}), NAMES).collect(), key=str)


def test_small_groups_nan_and_empty(spark):
    df = spark.createDataFrame([("x", "f", 2.0), ("y", "f", 1.0), ("y", "f", 3.0), ("z", "f", None), ("z", "f", math.nan)], "channel string, format string, v double")
    got = {r.channel: (r.n, r.p50, r.p99) for r in percentiles(value_counts(df, keys(), {"v": F.col("v")}), NAMES).collect()}
    assert got == {"x": (1, 2.0, 2.0), "y": (2, 2.0, 2.98)}
    assert percentiles(value_counts(df.limit(0), keys(), {"v": F.col("v")}), NAMES).count() == 0


def test_levels(spark):
    got = lifetime_percentiles(spark.read.parquet("/root/testdata/sf0.001/lifetime_daily.parquet"))
    n = got.groupBy("metric", "level").agg(F.sum("n").alias("n")).collect()
    by = {(r.metric, r.level): r.n for r in n}
    assert by["ctr", "channel"] == by["ctr", "channel_format"] and by["impressions", "channel"] == by["impressions", "channel_format"]
