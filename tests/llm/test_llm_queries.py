import glob
import os

import pytest

from corpusloom.llm import queries as q

TINY = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("verdict_id", "bigint"), ("defect", "string")], "p2_found": [("clip_id", "bigint")], "p4_found": [("clip_id_a", "bigint"), ("clip_id_b", "bigint")], "p5_found": [("tbl", "string"), ("row_id", "bigint")],
    "p6_found": [("video_id", "string"), ("line_no", "int")], "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p9_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query(spark, name):
    df = q.queries()[name](spark, TINY)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    rows = df.collect()
    assert rows
    if name not in q.oracle_sql():
        return
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{TINY}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    cursor = c.execute(q.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[n]) for n in sorted(df.columns)) for r in rows), key=str)
    assert got == sorted((tuple(plain(r[names.index(n)]) for n in sorted(df.columns)) for r in cursor.fetchall()), key=str)


def test_same_result_under_any_partitioning(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name in ("p1_found", "p4_found", "p6_found", "p9_found", "p3_percentiles"):
            seen = []
            for n in ("1", "7"):
                spark.conf.set("spark.sql.shuffle.partitions", n)
                seen.append(sorted(map(str, q.queries()[name](spark, TINY).collect())))
            assert seen[0] == seen[1], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty_tables(spark, tmp_path):
    for f in glob.glob(f"{TINY}/*.parquet"):
        df = spark.read.parquet(f)
        (df if "profiles" in f else df.limit(0)).write.parquet(f"{tmp_path}/{os.path.basename(f)}")
    for name, f in q.queries().items():
        assert f(spark, str(tmp_path)).count() == 0, name
