"""Sinks: pipe CSV, chat JSONL, reports, manifests, append-only metrics, registries."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.joins import upsert


def write_metadata(df: DataFrame, path: str) -> None:
    """K1: audio_file|text|speaker_name per split (a folder split=... each); a pipe in a text becomes a slash, quotes are quoted."""
    rows = df.select("audio_file", F.translate("text", "|", "/").alias("text"), "speaker_name", "split")
    rows.write.mode("overwrite").partitionBy("split").option("sep", "|").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_chat(df: DataFrame, path: str) -> None:
    """K2: chat JSONL per split."""
    df.select("messages", "split").write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(path)


def transcript(words: DataFrame, by: str, pause: float = 1.5) -> DataFrame:
    """K4: a readable transcript per source: a new paragraph after a pause of ``pause`` seconds, [heard-only passages] in brackets."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy("pos")
    start, off = F.col("start_s"), F.col("source") == "whisper"
    rows = words.withColumn("_gap", start - F.lag("end_s").over(w)).withColumn("_was", F.lag(off).over(w)).withColumn("_next", F.lead(off).over(w)).withColumn("_off", off)
    opens, closes = F.col("_off") & ~F.coalesce("_was", F.lit(False)), F.col("_off") & ~F.coalesce("_next", F.lit(False))
    say = F.concat(F.when(F.col("_gap") >= pause, "\n\n").otherwise(F.when(F.col("_gap").isNull(), "").otherwise(" ")), F.when(opens, "[").otherwise(""), F.col("word"), F.when(closes, "]").otherwise(""))
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", say.alias("t")))), lambda x: x["t"]), "")
    return rows.groupBy(by).agg(told.alias("text"))


def cut_report(clips: DataFrame, seconds: str = "seconds", width: float = 5.0) -> str:
    """K5: a Markdown report of clip lengths with a histogram: a line for each width that is not empty. Only those counts
    come to the driver."""
    n, total, mean = clips.agg(F.count("*"), F.coalesce(F.sum(seconds), F.lit(0.0)), F.coalesce(F.avg(seconds), F.lit(0.0))).first()
    bins = clips.where(F.col(seconds).isNotNull()).groupBy((F.floor(F.col(seconds) / width) * width).alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()
    rows = [f"| {b.b:g}-{b.b + width:g} s | {b.n} |" for b in bins]
    return "\n".join([f"# Clips\n\n{n} clips, {total / 60:.1f} min, mean {mean:.2f} s\n", "| length | clips |", "|---|---|", *rows])


def write_manifest(df: DataFrame, path: str) -> None:
    """Kept rows as a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def append_metric(spark: SparkSession, path: str, stage: str, **payload) -> None:
    """K7: one JSON line more; a metric that cannot be written never stops a run."""
    try:
        line = json.dumps({"ts": time.time(), "stage": stage, **payload}, ensure_ascii=False)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
    except Exception as error:  # a sink of last resort
        print(f"metric not written: {error}")


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, key: str) -> DataFrame:
    """K8/K9: a Parquet registry with ``changes`` put over it, written beside it and then moved into its place."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    at, new, old = (fs_path(path + suffix) for suffix in ("", ".new", ".old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    merged = upsert(spark.read.parquet(path), changes, key) if fs.exists(at) else changes
    merged.write.mode("overwrite").parquet(path + ".new")
    if fs.exists(at):
        fs.delete(old, True)
        fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)
    return spark.read.parquet(path)


def write_text_files(df: DataFrame, path: str, name: str, text: str) -> None:
    """K3: one text file per row would not scale; rows are written as text, partitioned by a hash bucket and named in a column."""
    df.select(F.col(name).alias("name"), F.col(text).alias("text")).write.mode("overwrite").json(path)
