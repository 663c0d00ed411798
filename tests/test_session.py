import pytest
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.functions import text
from corpusloom.sources import sinks


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    few = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert hinted(session.checked_broadcast(few)) and not hinted(session.checked_broadcast(few, rows=9)) and not hinted(session.checked_broadcast(few, most=9000))
    nested = few.select(F.array("t", "t").alias("a"), F.struct("t").alias("s"))
    assert hinted(session.checked_broadcast(nested)) and not hinted(session.checked_broadcast(nested, most=9000))


def test_only_small_tables_are_dealt_out(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "x.parquet"))
    assert session.table(spark, str(tmp_path), "x", spread=True).rdd.getNumPartitions() == 4
    assert session.table(spark, str(tmp_path), "x").rdd.getNumPartitions() == 1
    monkeypatch.setattr(session, "SMALL_BYTES", 100)
    assert session.table(spark, str(tmp_path), "x", spread=True).rdd.getNumPartitions() == 1


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), type("Conf", (), {"get": staticmethod(lambda name, default: default)})()

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())


def test_titles_with_many_marks_and_reports_with_many_bins(spark):
    t = "A quiet hill" + "".join(f" | P{i}" for i in range(1, 13))
    assert [r[0] for r in spark.createDataFrame([(t,), (None,), ("",)], "t string").select(text.clean_title(F.col("t"))).collect()] == ["A quiet hill", None, ""]
    report = sinks.cut_report(spark.range(300).select((F.col("id") * 5.0).alias("seconds")))
    assert report.count("\n| ") == 301 and "| 1495-1500 s | 1 |" in report
