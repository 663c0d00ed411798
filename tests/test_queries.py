import pytest

import __spark_entry__ as entry

TINY = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query_each():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.registry.queries()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import glob
    import os

    df = entry.registry.queries()[name](spark, TINY)
    rows = df.collect()
    if name not in entry.registry.oracle_sql():
        return
    c = duckdb.connect()
    for f in glob.glob(f"{TINY}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    cursor = c.execute(entry.registry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v
    got = sorted((tuple(plain(r[n]) for n in sorted(df.columns)) for r in rows), key=str)
    want = sorted((tuple(plain(r[names.index(n)]) for n in sorted(df.columns)) for r in cursor.fetchall()), key=str)
    assert got == want


def test_title_edit_ratio_all_in_any_script(spark, tmp_path):
    def ratio(a, b):
        a, b = a.lower(), b.lower()
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        return round(d[-1] / max(len(a), len(b)), 6) if a and b else 1.0

    histories = [["Plain title", "Plain Titel"], ["Die Küste", "Die Kuste", "DIE KÜSTE – Teil 2"], ["灰色の本を買う", "灰色の本"], ["“Niño” d’été", '"Nino" d\'ete'], ["İx", "b"], ["😀 a", "a", ""], ["é", None, "è"], [None], [], None]
    verdicts = spark.createDataFrame(list(enumerate(histories)), "verdict_id long, titles array<string>")
    verdicts.write.parquet(f"{tmp_path}/verdicts.parquet")
    want = {(v, i): ratio(a, b) for v, h in enumerate(histories) for i, (a, b) in enumerate(zip(h or [], (h or [])[1:]), 1) if a is not None and b is not None}
    got = {(r.verdict_id, r.change): r.ratio for r in entry.queries()["title_edit_ratio_all"](spark, str(tmp_path)).collect()}
    assert got == want and len(want) == 8 and 0 < want[1, 1] < 0.2
    assert {(r.verdict_id, r.change) for r in entry.queries()["title_edit_ratio"](spark, str(tmp_path)).collect()} < set(want)
