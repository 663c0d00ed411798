import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import reports


def test_joins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    b = spark.createDataFrame([("x", "X"), ("y", "Y"), ("y2", "Z")], "k string, name string")
    assert sorted(map(tuple, reports.checked_join(a, b, "k").collect())) == [("x", 1, "X"), ("y", 2, "Y")]
    with pytest.raises(Exception, match="no match for z"):
        reports.checked_join(spark.createDataFrame([("z", 1)], "k string, n int"), b, "k").collect()
    wavs = spark.createDataFrame([("b/A.wav",), ("a/a.WAV",), ("c/q.wav",)], "wav string")
    key = F.regexp_extract(F.lower("wav"), r"([^/]+)\.wav$", 1)
    left = spark.createDataFrame([("a",), ("z",)], "stem string")
    assert [tuple(r) for r in reports.first_match(left, wavs, F.col("stem"), key, ["wav"]).collect()] == [("a", "a/a.WAV")]
    assert reports.tagged_union({"p": a, "q": a}).groupBy("part_set").count().count() == 2
    whole = spark.createDataFrame([("x", "hello world")], "k string, text string")
    parts = spark.createDataFrame([("x", "one", 0, 5), ("x", "two", 6, 11)], "k string, name string, start int, end int")
    assert {r.name: r.text for r in reports.slices(whole, parts, "k").collect()} == {"one": "hello", "two": "world"}


def test_picks(spark):
    df = spark.range(100).select(F.col("id").alias("i"), F.lit(6.0).alias("s"))
    assert 48 <= reports.spread_subset(df, ["i"], "s", 300.0).count() <= 52 and reports.spread_subset(df, ["i"], "s", 9e9).count() == 100 and reports.spread_subset(df.limit(0), ["i"], "s", 5).count() == 0
    t = spark.createDataFrame([(1, 250), (2, 130), (3, 300), (4, 50), (5, 150)], "i int, n int")
    assert [r.i for r in reports.banded_pick(t, F.col("n"), ["i"], 3).collect()] == [1, 3, 2]
    names = [r.name for r in reports.numbered_names(t, ["n"], "c_", 3).orderBy("n").collect()]
    assert names == ["c_001", "c_002", "c_003", "c_004", "c_005"]
    said = spark.createDataFrame([(1, "then Kelba, came"), (2, None)], "k int, t string")
    fix = spark.createDataFrame([("Kelba", "Kelda")], "token string, name string")
    assert {r.k: r.t for r in reports.apply_names(said, "k", "t", fix).collect()} == {1: "then Kelda, came", 2: None}


def test_summaries(spark):
    s = spark.createDataFrame([("a", 0.0, 1.0), ("a", 3.0, 3.05), ("a", 9.0, 10.0)], "k string, start double, end double")
    total = spark.createDataFrame([("a", 0.0, 12.0)], "k string, lo double, hi double")
    got = sorted((r.kind, r.start, r.end) for r in reports.speech_between(s, ["k"], total, 0.12).collect())
    assert got == [("gap", 0.0, 1.0), ("gap", 9.0, 10.0), ("speech", 1.0, 3.0), ("speech", 3.05, 9.0), ("speech", 10.0, 12.0)]
    costs = spark.createDataFrame([(1, 6.0, "accepted"), (1, 3.0, "idle"), (1, 1.0, "rejected")], "b int, seconds double, state string")
    assert tuple(reports.cost_shares(costs, ["b"]).first())[2:] == (0.6, 0.1, 0.3)
    m = spark.createDataFrame([("x", float(i), 70.0 + i, 2000.0) for i in range(50)], "stage string, ts double, temp double, mhz double")
    r = reports.last_metrics(m, "stage").first()
    assert (r.events, r.since, r.hottest, r.throttled) == (40, 10.0, 119.0, True)
    cues = spark.createDataFrame([("s", i, i * 6.0, i * 6.0 + 6, q) for i, q in enumerate([False, False, False, True, False])], "k string, cue_idx int, start double, end double, in_quote boolean")
    assert [(r.start, r.end) for r in reports.narration_runs(cues, "k").collect()] == [(0.0, 18.0)]
    doc = spark.createDataFrame([(json.dumps({"driftSelfCheck": {"medianOffset": 0.1, "max": 2.0, "correctedCues": 3}}),)], "value string")
    row = reports.coverage_numbers(doc).first()
    assert (row.median, row.p95, row.max, row.corrected) == (0.1, None, 2.0, 3)
    with pytest.raises(Exception, match="no drift"):
        reports.coverage_numbers(spark.createDataFrame([("{}",)], "value string")).collect()
    c = reports.clusters(spark.createDataFrame([(10.0, 1.0), (12.0, 5.0), (30.0, 2.0)], "hz double, p double"), "hz", "p", 25, 1).orderBy("bin").collect()
    assert [(x.bin, x.n, x.exemplars) for x in c] == [(0.0, 2, [5.0]), (25.0, 1, [2.0])]
    g = spark.createDataFrame([(1.0, 0.5), (0.4, 0.9)], "i double, t double").select(reports.assembly_gap(F.col("i"), F.col("t"))).collect()
    assert [x[0] for x in g] == [0.25, 0.0]
