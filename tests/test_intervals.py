import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import intervals as iv
from corpusloom.operators import planner


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


@pytest.mark.parametrize("flags,least,want", [("", 1, []), ("000", 1, []), ("1100", 2, [(0, 1)]), ("0110111", 3, [(4, 6)]), ("1", 1, [(0, 0)])])
def test_threshold_runs(spark, flags, least, want):
    df = frame(spark, [("a", i, f == "1") for i, f in enumerate(flags)], "g string, i int, f boolean")
    got = sorted((r.first_row, r.last_row) for r in iv.threshold_runs(df, ["g"], ["i"], F.col("f"), least).collect())
    assert got == want
    inner = iv.threshold_runs(df, ["g"], ["i"], F.col("f"), least, edges=False).collect()
    assert sorted((r.first_row, r.last_row) for r in inner) == [w for w in want if w[0] > 0 and w[1] < len(flags) - 1]


def brute_union(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def test_union_and_complement(spark):
    r = random.Random(1)
    spans = {g: [(a, a + r.randint(0, 9)) for a in (r.randint(0, 200) for _ in range(30))] for g in "ab"} | {"c": [(0, 5), (5, 9), (2, 3), (2, 3)]}
    df = frame(spark, [(g, a, b) for g, x in spans.items() for a, b in x] + [("a", None, 3), ("a", 9, 1)], "g string, start int, end int")
    got = {}
    for row in iv.union(df, ["g"]).orderBy("g", "start").collect():
        got.setdefault(row.g, []).append((row.start, row.end))
    assert got == {g: brute_union(x) for g, x in spans.items()}
    total = frame(spark, [(g, 0, 220) for g in "abcd"], "g string, lo int, hi int")
    free = {}
    for row in iv.complement(df, ["g"], total).orderBy("g", "start").collect():
        free.setdefault(row.g, []).append((row.start, row.end))
    for g in "abcd":
        edges, at = [], 0
        for a, b in brute_union(spans.get(g, [])):
            if a > at:
                edges.append((at, a))
            at = max(at, b)
        assert free.get(g, []) == edges + ([(at, 220)] if at < 220 else [])


def test_nearest_and_containment(spark):
    r = random.Random(3)
    points = [(i, r.choice("ab"), r.uniform(0, 100)) for i in range(200)]
    gaps = [(j, r.choice("ab"), x, x + r.uniform(0, 3)) for j, x in enumerate(r.uniform(0, 100) for _ in range(40))]
    p, g = frame(spark, points, "id int, k string, t double"), frame(spark, gaps, "gid int, k string, g0 double, g1 double")
    got = {row.id: (row.gid, round(row.distance, 9)) for row in iv.nearest(p, g, ["k"], "id", F.col("t"), F.col("g0"), F.col("g1"), 5.0, "gid", 2.0).collect()}
    want = {}
    for i, k, t in points:
        c = [(max(0.0, a - t, t - b), j) for j, kk, a, b in gaps if kk == k and a - 2.0 <= t <= b + 2.0]
        if c:
            want[i] = (min(c)[1], round(min(c)[0], 9))
    assert got == want
    rows = frame(spark, [(i, "a", float(i), i + 1.0) for i in range(20)], "id int, k string, start double, end double")
    bad = frame(spark, [("a", 3.0, 5.0), ("a", 7.5, 7.6), ("b", 0.0, 50.0)], "k string, start double, end double")
    assert sorted(x.id for x in iv.without_excluded(rows, bad, ["k"], 4.0).collect()) == [i for i in range(20) if i not in (3, 4, 7)]


def test_texts_by_midpoint_is_half_open(spark):
    units = frame(spark, [("s", 0, 0.0, 2.0, "a"), ("s", 1, 1.0, 3.0, "b"), ("s", 2, 3.0, 5.0, "c ")], "src string, i int, start double, end double, text string")
    spans = frame(spark, [("s", 7, 1.0, 2.0), ("s", 8, 2.0, 9.0)], "src string, span_id int, a double, b double")
    assert {r.span_id: r.text for r in iv.texts_by_midpoint(units, spans, ["src"], "i", 1.0).collect()} == {7: "a", 8: "b c"}


def test_snap_last_writer_wins(spark):
    cues = frame(spark, [("s", 0, 1.0, True, False, True), ("s", 1, 1.1, True, False, False), ("s", 2, 9.0, True, False, True), ("s", 3, 20.0, False, False, False), ("s", 4, 21.0, True, True, False)], "src string, cue_idx int, end double, final boolean, heading boolean, open_after boolean")
    gaps = frame(spark, [("s", 1.05, 1.3), ("s", 9.0, 12.0), ("s", 20.0, 20.4)], "src string, g0 double, g1 double")
    got = {r.pos: (r.struct, r.quote_safe) for r in iv.snap_boundaries(cues, gaps, "src", 0.15).collect()}
    assert got == {1.3: (False, True), 12.0: (True, True), 20.4: (True, True)}


def test_parts_and_running(spark):
    sizes = [5, 1, 1, 9, 4, 2, 2, 6]
    df = frame(spark, list(enumerate(sizes)), "i int, n int").repartition(3)
    got = [r.part for r in iv.sized_parts(df, [], ["i"], "n", 3).orderBy("i").collect()]
    before = [sum(sizes[:i]) for i in range(len(sizes))]
    assert got == [min(2, b * 3 // sum(sizes)) for b in before]
    assert [r.before for r in iv.global_running(df, ["i"], "n").orderBy("i").collect()] == before
    two = frame(spark, [(g, i, n) for g in ("a", None) for i, n in enumerate(sizes)], "g string, i int, n int").repartition(5)
    for r in iv.grouped_running(two, ["g"], ["i"], "n").collect():
        assert (r.before, r.row, r.total, r.rows) == (before[r.i], r.i, sum(sizes), len(sizes))
    by = iv.sized_parts(df.withColumn("g", F.lit(1)), ["g"], ["i"], "n", 3).orderBy("i").collect()
    assert [r.part for r in by] == got
    assert iv.sized_parts(df.limit(0), [], ["i"], "n", 3).count() == 0


def test_planner():
    import itertools

    b = [(4.0, False, True), (9.0, False, False), (11.0, False, True), (14.0, True, True), (30.0, False, False), (33.0, False, True)]
    clips, deferred, forced = planner.plan_clips(b, 0.0, itertools.repeat(8.0), 15.0)
    assert clips == [(0.0, 11.0, False), (11.0, 14.0, True), (14.0, 30.0, False), (30.0, 33.0, False)]
    assert (deferred, forced) == (1, 1)
    assert planner.merge_spans([(0, 2), (2, 4), (4, 9), (9, 30)], 5, 10) == [(0, 9), (9, 30)]
    assert planner.split_at_gaps((0, 30), [(9, 11, 10), (14, 17, 16), (20, 20.5, 20.1)], 12) == [(0, 10), (10, 16), (16, 20.1), (20.1, 30)]
    assert planner.split_at_gaps((0, 30), [(9, 11, 31)], 12) == [(0, 30)]
    parts = planner.split_at_gaps((0, 30), [(9, 11, 9.5), (14, 17, 15)], 12)
    assert parts[0][0] == 0 and parts[-1][1] == 30 and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
    assert planner.probe_cues([0, 100, 310, 590, 900], 300) == [2, 3, 4]
    assert planner.cap_parts([3, 3, 3, 9, 1], 7) == [0, 0, 1, 2, 3]


def test_spans_of_sources(spark):
    spans = frame(spark, [("s", 0.0, 2.0), ("s", 2.0, 4.0), ("s", 4.0, 9.0), ("s", 9.0, 30.0), ("t", 1.0, 2.0)], "src string, a double, b double")
    merged = planner.merged_spans(spans, "src", 5, 10)
    assert sorted(tuple(r) for r in merged.collect()) == [("s", 0, 0.0, 9.0), ("s", 1, 9.0, 30.0), ("t", 0, 1.0, 2.0)]
    gaps = frame(spark, [("s", 14.0, 17.0, 16.5), ("s", 20.0, 21.0, None), ("t", 1.2, 1.4, None)], "src string, g0 double, g1 double, quiet double")
    got = sorted((r.src, r.a, r.b) for r in planner.split_spans(merged, gaps, "src", 12).collect())
    assert got == [("s", 0.0, 9.0), ("s", 9.0, 16.5), ("s", 16.5, 20.5), ("s", 20.5, 30.0), ("t", 1.0, 2.0)]
    cues = frame(spark, [("s", i, float(x)) for i, x in enumerate([0, 100, 310, 590, 900])] + [("s", 9, None)], "src string, i int, start double")
    assert [(r.i, r.probe) for r in planner.probes(cues, "src", "start", 300).orderBy("probe").collect()] == [(2, 0), (3, 1), (4, 2)]
    assert [r.part for r in planner.capped_parts(cues, "src", "i", "i", 3).orderBy("i").collect()][:3] == [0, 0, 0]


def test_opening_words_are_heard_in_order(spark):
    cues = frame(spark, [("s", 1, 4.5, "one two three four".split()), ("s", 2, 4.5, "two one three four".split()), ("s", 3, 4.5, ["one", "two", "nine"]), ("s", 4, 400.0, ["one", "two"]), ("s", 5, 4.5, []), ("s", 6, 4.0, None)], "src string, cue int, start double, tokens array<string>")
    heard = frame(spark, [("s", i, w, a) for i, (w, a) in enumerate([("x", 1.0), ("one", 5.0), ("two", 5.2), ("three", 5.4), ("four", 5.6), ("one", 4.0)])], "src string, pos int, token string, at double")
    got = {r.cue: round(r.offset, 6) for r in planner.opening_offsets(cues, heard, "src", "cue", 30.0).collect()}
    assert got == {1: 0.5, 3: 0.5}


def test_planned(spark):
    df = frame(spark, [("s", 0.0, False, True), ("s", 6.0, False, True), ("s", 11.0, False, True), ("t", 1.0, False, True)], "src string, pos double, struct boolean, quote_safe boolean")
    assert [(r.src, r.clip, r.a, r.b) for r in planner.planned(df, "src", 5.0, 20.0).orderBy("src", "clip").collect()] == [("s", 0, 0.0, 6.0), ("s", 1, 6.0, 11.0)]


def test_sizes_of_zero(spark):
    df = frame(spark, [(0, 0), (1, 0), (2, None)], "i int, n int")
    assert {r.part for r in iv.sized_parts(df, [], ["i"], "n", 3).collect()} == {0}
    assert {r.part for r in iv.sized_parts(df.withColumn("g", F.lit("x")), ["g"], ["i"], "n", 3).collect()} == {0}
