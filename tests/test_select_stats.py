import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators import gates, glossary, joins, select


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "i").repartition(3)


@pytest.mark.parametrize("n,share", [(1, 0.15), (7, 0.15), (20, 0.05), (40, 0.15), (101, 0.3), (10, 1.0), (3, 0.01)])
def test_even_spread(spark, n, share):
    k = int(np.round(n * share))
    want = set() if k < 1 else {0} if k == 1 else {int(x) for x in np.round(np.arange(k) * ((n - 1) / (k - 1)))} | {n - 1}
    rows = select.even_spread(ids(spark, n), ["i"], share).collect()
    assert len(rows) == n and {r.i for r in rows if r.split == "eval"} == want


@pytest.mark.parametrize("n", [1, 2, 13, 100])
def test_splits_and_samples(spark, n):
    df = ids(spark, n)
    k = max(1, int(np.round(n * 0.08)))
    assert {r.i for r in select.chronological_split(df, ["i"], 0.08).where("split = 'eval'").collect()} == set(range(n - k, n))
    step = max(1, n // 10)
    assert [r.i for r in select.stride_sample(df, ["i"], 10).orderBy("i").collect()] == list(range(n))[::step][:10]
    assert {r.i for r in select.modulo_split(df, ["i"]).where("split = 'eval'").collect()} == {i for i in range(n) if i % 10 == 4}


def test_empty_and_failures(spark):
    df = ids(spark, 0)
    for f in (lambda: select.chronological_split(df, ["i"], 0.1), lambda: select.even_spread(df, ["i"], 0.1), lambda: select.stride_sample(df, ["i"], 3), lambda: select.budget(df.withColumn("n", F.lit(1)), ["i"], "n", 5)):
        assert f().count() == 0
    assert select.shuffled_holdout(ids(spark, 20), "i", 5).where("split = 'eval'").count() == 5
    with pytest.raises(Exception, match="takes all rows"):
        select.shuffled_holdout(ids(spark, 5), "i", 5).count()


@pytest.mark.parametrize("need,kept", [(10, 4), (11, 5), (1, 1), (999, 6), (0, 0)])
def test_budget_keeps_the_row_that_crosses(spark, need, kept):
    df = ids(spark, 6).withColumn("n", F.lit(3) - F.col("i").cast("int") % 2)  # 3 2 3 2 3 2
    assert select.budget(df, ["i"], "n", need).count() == kept


def test_bucket_weights_and_determinism(spark):
    df = select.bucket_targets(ids(spark, 20_000), "i", [(2, 3, 10), (3, 10, 20)])
    short = df.where("target < 10").count() / 20_000
    assert abs(short - 0.4) < 0.02 and df.agg(F.min("target"), F.max("target")).first()[0] >= 3
    a, b = (sorted(map(tuple, select.bucket_targets(ids(spark, 50).repartition(p), "i", [(1, 0, 1)]).collect())) for p in (1, 4))
    assert a == b


def test_round_robin_and_fill(spark):
    df = spark.createDataFrame([(g, i, 10) for g, n in (("a", 9), ("b", 2)) for i in range(n)], "g string, i int, n int")
    got = sorted((r.g, r.turn, r.i) for r in select.round_robin(df, "g", ["i"], 3).collect())
    assert got == [("a", 0, 3), ("a", 1, 4), ("a", 2, 5), ("b", 0, 0), ("b", 1, 1)]
    assert select.capped_fill(df, F.col("g") == "a", ["i"], "n", 25).where("g = 'a'").count() == 3


def test_statistics(spark):
    r = random.Random(5)
    values = [r.choice([1.0, 2.0, 3.5, r.random() * 9]) for _ in range(41)]
    df = spark.createDataFrame([("g", v) for v in values] + [("one", 4.0), ("none", None)], "g string, v double")
    s = sorted(values)
    picks, points = {"u": stats.upper_index, "p": stats.nearest_index(0.95)}, {"m": 0.5, "q": 0.9}
    got = {x.g: x for x in stats.order_statistics(df, ["g"], "v", picks, points).collect()}
    assert set(got) == {"g", "one"} and got["one"].u == got["one"].m == 4.0
    assert got["g"].u == s[20] and got["g"].m == np.median(s) and got["g"].p == s[round(0.95 * 40)] and np.isclose(got["g"].q, np.percentile(s, 90))
    whole = stats.order_statistics(df.where("g = 'g'"), [], "v", {"u": stats.upper_index}).collect()
    assert [x.u for x in whole] == [s[20]] and stats.order_statistics(df.limit(0), [], "v", {"u": stats.upper_index}).count() == 0


def test_a_hot_group_is_spread(spark):
    """A third of all rows in one group, at many partitions: the same numbers."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"), ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    got = {r.g: r for r in stats.order_statistics(df, ["g"], "v", {}, {"m": 0.5}).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert {g: r.m for g, r in got.items()} == want
    below = {(r.g, r.v): r.pct_below for r in stats.percent_below_scaled(df, "v", ["g"]).collect()}
    assert below == {(r.g, r.v): r.p for r in df.withColumn("p", stats.percent_below(F.col("v"), "g")).collect()}


def test_percentiles_of_the_table(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (4.0, None)], "a double, b double")
    r = select.with_percentiles(df, {"m": ("a", 0.5), "n": ("b", 0.9)}).collect()
    assert {(x.m, x.n) for x in r} == {(2.0, 5.0)} and len(r) == 3
    assert select.with_percentiles(df.limit(0), {"m": ("a", 0.5)}).count() == 0
    assert [x.m for x in select.with_percentiles(df.where("a = 1").select("b"), {"m": ("b", 0.5)}).collect()] == [None]


def test_percent_below_with_ties(spark):
    data = [("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = sorted(((r.g or "", r.v or 0, r.pct_below) for r in stats.percent_below_scaled(df, "v", ["g"]).collect()), key=str)
    want = []
    for g, v in data:
        pool = [x for h, x in data if h == g and x is not None]
        want.append((g or "", v or 0, None if v is None else 100.0 * sum(x < v for x in pool) / len(pool)))
    assert got == sorted(want, key=str)


def test_histograms(spark):
    df = spark.createDataFrame([(float(i),) for i in range(25)] + [(None,)], "v double")
    assert {r.bin: r.n for r in stats.equal_bins(df, "v", 12).collect()} == dict(enumerate(np.histogram(range(25), 12)[0].tolist()))
    assert stats.equal_bins(df.where("v = 3"), "v", 12).collect()[0].bin == 0
    parts = stats.chrono_parts(df.where("v is not null").withColumn("g", F.lit(1)), ["v"], 10, ["g"]).orderBy("v").collect()
    want = [d for d in range(10) for _ in range(d * 25 // 10, (d + 1) * 25 // 10)]
    assert [p.part for p in parts] == want


def test_gates(spark):
    w = [f"w{i}" for i in range(9)]
    rows = [(0, "x" * 10, w, 1.0, 1.0), (1, "x" * 10, w[:6] + w[:6], 1.0, 0.1), (2, "x" * 10, w, 1.0, 0.5), (3, "x" * 10, w, 1.6, 1.0), (4, "x" * 10, w, None, 1.0), (5, "", [], 1.0, 1.0), (6, "x" * 10, w, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "i int, text string, said array<string>, seconds double, cov double")
    out = gates.loop_gate(df, F.col("seconds").isNull(), F.col("said"), F.col("cov"), F.col("seconds"), F.col("text"))
    assert {r.i: r.verdict for r in out.collect()} == {0: "ok", 1: "LOOP", 2: "DROP", 3: "BLOAT", 4: "FAIL", 5: "ok", 6: "ok"}
    assert gates.verdict_counts(out).first().passed is False and gates.verdict_counts(out.where("verdict = 'ok'")).first().passed
    t = spark.createDataFrame([([1, 1, 2, 2, 2, 3],), ([],)], "x array<int>").select(gates.tail_loop(F.col("x"), 5).alias("t")).collect()
    assert (t[0].t.unique, t[0].t.longest, t[1].t.longest) == (3, 3, 0)
    losses = spark.createDataFrame([(1, i, v) for i, v in enumerate([5.0, 4.0, 4.5, 4.1, 3.0, 3.0, 3.1])], "g int, i int, loss double")
    assert [r.stale for r in gates.early_stop(losses, ["g"], "i", "loss", 2).orderBy("i").collect()] == [0, 0, 1, 2, 0, 1, 2]
    streak = gates.failure_streaks(losses, ["g"], "i", F.col("loss") < 4.2).orderBy("i").collect()
    assert [r.streak for r in streak] == [1, 0, 1, 0, 0, 0, 0]
    v = spark.createDataFrame([(2.0, 4.0, 0, 1.0, 9, 0.9), (0.1, 4.0, 3, 1.0, 0, 0.0)], "m double, d double, c int, t double, k int, n double")
    assert [len(r[0]) for r in v.select(gates.verify_failures(*(F.col(c) for c in "mdctkn"))).collect()] == [2, 0]


def test_joins(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, n int, keep string")
    new = spark.createDataFrame([("b", 9), ("c", 5)], "k string, n int")
    assert sorted(((r.k or "", r.n, r.keep) for r in joins.upsert(base, new, "k").collect()), key=str) == [("", 3, "z"), ("a", 1, "x"), ("b", 9, "y"), ("c", 5, None)]
    cues = spark.createDataFrame([(1, ["chapter", "two", "the", "hill"]), (2, ["the", "hill"] * 7), (3, ["hill"]), (4, [])], "i int, w array<string>")
    heads = spark.createDataFrame([(["the", "hill"],), ([],)], "h array<string>")
    assert [r.i for r in joins.contains_all(cues, "w", heads, "h").collect()] == [1]
    tokens = spark.createDataFrame([("Sorireon",), ("abc",), ("Kelda",), ("Kelda's",), ("Zzzzzzz",)], "token string")
    names = spark.createDataFrame([("Sorirson",), ("Kelda",)], "name string")
    assert {r.token: r.name for r in joins.fuzzy_names(tokens, names).collect()} == {"Sorireon": "Sorirson", "Kelda's": "Kelda"}
    r = random.Random(8)
    ns = ["".join(r.choice("abc") for _ in range(r.randint(2, 12))) for _ in range(60)]
    ts = ["".join(r.choice("abc") for _ in range(r.randint(4, 12))) for _ in range(120)]

    def ratio(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            left, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
        return row[-1] / max(len(a), len(b))

    want = {}
    for t in set(ts) - set(ns):
        least = min((ratio(t, n), n) for n in ns if abs(len(n) - len(t)) <= 3)
        if least[0] <= (0.2 if len(t) <= 5 else 0.3):
            want[t] = least[1]
    frames = [spark.createDataFrame([(x,) for x in xs], f"{c} string") for xs, c in ((ts, "token"), (ns, "name"))]
    assert {r.token: r.name for r in joins.fuzzy_names(*frames).collect()} == want and want
    b = spark.createDataFrame([(1, "p q r s t u v w".split())], "book_key int, words array<string>")
    h = spark.createDataFrame([(2, "x q r s t u v w".split())], "heard_key int, words array<string>")
    assert [tuple(r) for r in joins.longest_runs(joins.seeds(b, h)).collect()] == [(1, 2, 1, 1, 7)]


def test_glossary(spark):
    text = "Then Kelda came. I saw Kelda and the lamp. Lamp was lit. lamp lamp lamp lamp lamp. O'Hara left. See O'Hara there. Zed. I'll go, I'm here, and I'll say I've I'm. I'd say I'd."
    got = {r.name: r.n for r in glossary.glossary(spark.createDataFrame([(text,), (None,)], "t string"), "t").collect()}
    assert got == {"Kelda": 2, "O'Hara": 2}


def test_glossary_pairs(spark):
    texts = ["Then Mater Mundi came. The old Mater Mundi's hall. Mater", "Mundi Mater. Only BB Chojiro’s brother and BB Chojiro. Red Lamp, Red Lamp. The Kelda The Kelda", "lamp " * 5, "O'Hara Ann O'Hara Ann", "", None]
    got = {r.name: r.n for r in glossary.glossary_pairs(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()}
    assert got == {"Mater Mundi": 2, "BB Chojiro": 2, "O'Hara Ann": 2}
