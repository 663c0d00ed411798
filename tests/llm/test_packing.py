from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import packing
from corpusloom.llm.packing import BoundedPacker, fill_report, pack, pack_documents, pieces


def test_pieces():
    assert pieces(0, 10) == [(0, 0)] and pieces(10, 10) == [(0, 10)]
    assert pieces(25, 10) == [(0, 10), (10, 10), (20, 5)]


def test_best_fit_and_fullest_is_emitted():
    p = BoundedPacker(10, 2)
    assert p.place(6) == 0 and p.place(7) == 1  # rooms 4 and 3
    assert p.place(3) == 1  # the tighter one, now full
    assert p.place(5) == 2 and p.place(9) == 3  # windows 0 (room 4) and 2 (room 5): 0 is the fullest and goes
    assert {at for _, at in p.windows} == {2, 3}


def check(rows, capacity):
    fill, seen = Counter(), Counter()
    for r in rows:
        fill[r.container] += r.tokens
        seen[r.doc_id] += r.tokens
    assert all(n <= capacity for n in fill.values())
    return fill, seen


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_whole_results_and_little_room(spark, parts):
    sizes = [(i, i * 37 % 90) for i in range(3000)] + [(3000, 250), (3001, None), (3002, 0)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens int").repartition(parts)
    rows = pack(df, [("p", 100), ("none", None), ("zero", 0)]).collect()
    fill, seen = check(rows, 100)
    assert dict(seen) == {i: n or 0 for i, n in sizes}
    split = {r.doc_id for r in rows if r.piece > 0}
    assert split == {3000}
    assert sum(seen.values()) / (100 * len(fill)) > (0.97 if parts == 1 else 0.85)


def test_empty_and_repeated(spark):
    assert pack(spark.createDataFrame([], "doc_id long, tokens int"), [("p", 10)]).count() == 0
    rows = pack(spark.createDataFrame([(1, 4)] * 5, "doc_id long, tokens int"), [("p", 10)]).collect()
    assert len(rows) == 5 and check(rows, 10)[1][1] == 20


def test_documents(spark):
    d = "/root/testdata/sf0.001"
    docs, profiles = spark.read.parquet(d + "/documents.parquet"), spark.read.parquet(d + "/profiles.parquet")
    packed = pack_documents(docs, profiles)
    report = {r.profile: r for r in fill_report(packed, profiles).collect()}
    assert len({r.tokens for r in report.values()}) == 1 and len(report) == 4
    assert packed.where("piece = 0").groupBy("profile").count().select("count").distinct().collect()[0][0] == docs.count()


def test_rounds_over_all_partitions(spark):
    """Ten rounds' worth of groups: what stays open is packed until one group is left."""
    df = spark.createDataFrame([(i, 60 if i % 2 else 40) for i in range(400)], "doc_id long, tokens int").repartition(40)
    for fan_in in (2, 3, 64):
        rows = pack(df, [("p", 100), ("q", 250)], open_windows=4, fan_in=fan_in).collect()
        fill, seen = check([r for r in rows if r.profile == "p"], 100)
        assert len(seen) == 400 and sum(seen.values()) / (100 * len(fill)) > 0.85 and len(rows) == 800


def test_any_number_of_profiles_or_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    profiles = spark.range(1001).select(F.concat(F.lit("p"), "id").alias("profile"), F.lit(10).alias("max_seq_length"))
    assert pack_documents(docs, profiles).select("profile").distinct().count() == 1001
    monkeypatch.setattr(packing, "MOST_PROFILES", 1000)
    with pytest.raises(ValueError, match="profiles"):
        pack_documents(docs, profiles)
