import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text, udfs
from corpusloom.operators import align, gates, joins, reports, select


def test_paths(spark):
    rows = [("C:\\a b\\c.wav", "/mnt/c/a b/c.wav", "c"), ("D:", "/mnt/d/", "D:"), ("/x/y.tar.gz", "/x/y.tar.gz", "y.tar"), ("a\\b", "a/b", "b"), ("", "", ""), (None, None, None)]
    got = spark.createDataFrame(rows, "p string, w string, b string").select(text.wsl_path(F.col("p")).alias("got"), "w", text.basename(F.col("p")).alias("base"), "b").collect()
    assert all(r.got == r.w and r.base == r.b for r in got)


def test_by_basename(spark):
    files = spark.createDataFrame([("w/a.wav", 1), ("w/b.wav", 2), (None, 3)], "file string, text int")
    rows = spark.createDataFrame([("x/a.flac", "said", 9), ("x/c.flac", "no", 9)], "name string, said string, text int")
    assert [tuple(r) for r in joins.by_basename(files, rows, "file", "name").select("file", "text", "said").collect()] == [("w/a.wav", 1, "said")]
    assert joins.by_basename(files.limit(0), rows, "file", "name").count() == 0


def test_fidelity(spark):
    rows = [(0.0, ["a", "b"], ["a", "b"]), (0.1, ["a", "b", "c"], ["a", "x", "c"]), (None, [], ["a"]), (None, None, None)]
    df = spark.createDataFrame(rows, "e double, w array<string>, g array<string>")
    run = lambda d: gates.transcript_fidelity(d, F.col("e"), F.col("w"), F.col("g")).first()
    assert tuple(run(df)) == (2, 0.05, 0, 0, True)
    more = df.unionByName(spark.createDataFrame([(0.02, ["p", "q"], None)], df.schema))
    assert (run(more).first_missing, run(more).last_missing, run(more).passed) == (1, 1, False) and not run(df.limit(0)).passed


def test_mix_and_seed_set(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([1, 2, 2, 5, 10, 20])] + [(9, None)], "i int, s double")
    got = {r.lo: (r.wanted, r.clips, r.share) for r in select.mix_report(df, "s", [(1, 1.5, 3), (3, 3, 10), (0, 30, 40)]).collect()}
    assert got == {1.5: (0.25, 2, 2 / 3), 3.0: (0.75, 1, 1 / 3), 30.0: (0.0, 0, 0.0)}
    assert {r.share for r in select.mix_report(df.limit(0), "s", [(1, 1.5, 3)]).collect()} == {0.0}
    clips = spark.createDataFrame([(i, 10.0 if i % 2 else 1.0) for i in range(400)], "i int, s double")
    picked = [r.i for r in reports.seed_set(clips, ["i"], "s", low=900, high=1000).collect()]
    assert len(picked) == 100 and all(i % 2 for i in picked)
    with pytest.raises(ValueError, match="minutes"):
        reports.seed_set(clips.limit(10), ["i"], "s")


def test_common_words_of_repeated_pairs(spark):
    rows = [("a b c d", "b x d", 2)] * 3 + [("", "a", 0), (None, "a", None), ("a", "a", 1)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    assert all(r.got == r.n for r in df.select(udfs.lcs_words("a", "b").alias("got"), "n").collect())


def test_heard_stretches(spark):
    rows = [(0, 0.0, 0.5, "book"), (1, 1.0, 1.5, "whisper"), (2, 2.0, 3.1, "whisper"), (3, 4.0, 4.2, "book"), (4, 5.0, 5.1, "whisper")] + [(10 + i, 10 + i / 10, 10.05 + i / 10, "whisper") for i in range(5)]
    df = spark.createDataFrame([("s", *r) for r in rows], "stem string, pos int, start_s double, end_s double, source string")
    got = sorted((r.first_row, r.n, round(r.seconds, 2)) for r in align.heard_stretches(df, "stem").collect())
    assert got == [(1, 2, 2.1), (4, 6, 5.45)]
    assert align.heard_stretches(df.limit(0), "stem").count() == 0
