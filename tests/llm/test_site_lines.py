import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import site_lines
from corpusloom.llm.site_lines import Summary, repeated_lines, without_repeated


def brute(rows, least=5, share=0.05):
    key = lambda x: " ".join(x.casefold().split())
    docs, total = Counter(), Counter()
    for _, s, t in rows:
        if t is not None:
            total[s] += 1
            docs.update({(s, key(x)) for x in t.split("\n") if key(x)})
    return {(i, n) for i, s, t in rows if t is not None for n, x in enumerate(t.split("\n"), 1) if key(x) and docs[s, key(x)] >= max(least, share * total[s])}


def corpus():
    r = random.Random(4)
    legal = ["Follow us!", "  follow\tUS! ", "FOLLOW  us!", "Straße 1", "STRASSE 1", "read by X"]
    rows = []
    for i in range(900):
        s = r.choice(["hot", "hot", "a", "b", "c", None])
        lines = [f"line {r.randint(0, 4000)}" for _ in range(r.randint(0, 6))] + [x for x in legal if r.random() < 0.06] + ["", " \r"]
        if r.random() < 0.05 and s:
            lines.append(f"only {s}")
        r.shuffle(lines)
        rows.append((f"v{i}", s, None if r.random() < 0.05 else "" if r.random() < 0.05 else "\n".join(lines)))
    return rows


@pytest.mark.parametrize("sets_fit", [True, False])
def test_against_brute_force(spark, monkeypatch, sets_fit):
    monkeypatch.setattr(site_lines, "fits_broadcast", lambda df: sets_fit)
    rows = corpus()
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "video_id string, channel string, description string, source string, h int").repartition(6)
    places, confirmed = repeated_lines(df, "video_id", F.col("channel"), F.col("description"))
    got = [(r.video_id, r.line_no) for r in places.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows) and len(got) > 100
    clean = {r.video_id: r.description for r in without_repeated(df, "video_id", F.col("channel"), F.col("description"), confirmed).collect()}
    bad = brute(rows)
    for i, _, t in rows:
        assert clean[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in bad))
    assert confirmed.count() >= 4


def test_a_summary_that_may_miss_lines_is_not_trusted(spark, monkeypatch):
    monkeypatch.setattr(site_lines, "summarize", lambda docs, share: docs.groupBy("source").agg(F.lit(None).cast("long").alias("h"), F.count("*").alias("n")).select("source", "h", "n"))
    rows = corpus()
    df = spark.createDataFrame(rows, "video_id string, channel string, description string")
    places, _ = repeated_lines(df, "video_id", F.col("channel"), F.col("description"))
    got = [(r.video_id, r.line_no) for r in places.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_empty_and_blank(spark):
    schema = "video_id string, channel string, description string"
    assert repeated_lines(spark.createDataFrame([], schema), "video_id", F.col("channel"), F.col("description"))[0].count() == 0
    df = spark.createDataFrame([(str(i), "c", t) for i, t in enumerate([None, "", "  ", "x", "x", "x", "x"])], schema)
    assert repeated_lines(df, "video_id", F.col("channel"), F.col("description"))[0].count() == 0


def test_summary_error_bound():
    r = random.Random(1)
    s, exact = Summary(0.1), Counter()
    for _ in range(300):
        items = [r.choice([1, 2, 3]) if r.random() < 0.3 else r.randint(10, 100_000) for _ in range(20)]
        exact.update(set(items))
        hs, n = np.unique(sorted(set(items)), return_counts=True)
        s.add(hs, n, 1)
    assert all(0 <= exact[h] - s.counts.get(h, 0) <= s.taken for h in exact) and 0 < s.taken <= 0.1 * 0.5 * 300
    assert len(s.counts) < 2 * (s.items / (s.share * s.docs) + 1) + 1
