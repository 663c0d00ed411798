"""Typed readers for corpus files. Every schema is stated; a row that breaks it fails the read, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = "audio_file string, text string, speaker_name string"
ASR_WORD = "array<struct<word:string,start:double,end:double,prob:double>>"
VIDEOS = "videoId string, format string, publishedAt string"
VERDICTS = "videoId string, titles array<string>, lifetime struct<ctr:double,impressions:bigint>"
SNIPPETS = "fetched map<string,struct<title:string,description:string,tags:array<string>,fetchedAt:string>>, missing array<string>"
SCORES = "name string, bright double, dyn double, dur double"
SPLIT_MAP = (
    "sample_rate int, channels int, subtype string, parts array<struct<part:int,file:string,frames:bigint,"
    "entries:array<struct<clip:string,split:string,start_sample:bigint,end_sample:bigint,md5_16:string>>>>"
)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Pipe CSV with exactly the columns of METADATA, quoted where needed; split from the file's name
    (metadata_<split>.csv). Blank lines are skipped; another header or a broken row fails the read."""
    reader = spark.read.schema(T._parse_datatype_string(METADATA)).option("sep", "|").option("header", True).option("enforceSchema", False)
    rows = reader.option("mode", "FAILFAST").option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return rows.withColumn("split", F.regexp_extract(F.col("_metadata.file_name"), r"metadata_(\w+)\.csv", 1))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents of a stated schema, with path."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("path", F.col("_metadata.file_path"))


def asr_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of ASR files (a JSON list each): path, pos, word, start, end, prob."""
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", ASR_WORD, {"mode": "FAILFAST"}).alias("words"))
    return raw.select("path", F.posexplode("words").alias("pos", "w")).select("path", "pos", "w.*")


def keep_out_regions(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Start, end of the excluded regions of one file key; a key that is not there fails."""
    schema = "files map<string,struct<regions:array<struct<curation_decision:string,snapped_start_sec:double,snapped_end_sec:double>>>>"
    doc = read_json(spark, path, schema)
    known = F.assert_true(F.map_contains_key("files", F.lit(key)), F.lit(f"no regions for {key}"))
    regions = doc.where(known.isNull()).select(F.explode(F.col("files")[key]["regions"]).alias("r"))
    return regions.where("r.curation_decision = 'exclude'").select(F.col("r.snapped_start_sec").alias("start"), F.col("r.snapped_end_sec").alias("end"))


def flat_sentences(sentences: Column) -> Column:
    """A list of lists of sentences as one list; explode it with its position for global indices."""
    return F.flatten(sentences)


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    """Chat JSONL with its line kept as _corrupt_record where it is broken: messages, _corrupt_record."""
    schema = "messages array<struct<role:string,content:string>>, _corrupt_record string"
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_channel(spark: SparkSession, videos: str, verdicts: str, snippets: str) -> DataFrame:
    """Verdicts with their video (one that is missing fails) and their snippet (may be missing)."""
    v, d = read_json(spark, videos, f"array<struct<{_fields(VIDEOS)}>>"), read_json(spark, verdicts, f"array<struct<{_fields(VERDICTS)}>>")
    return channel_rows(v.drop("path"), d.drop("path"), read_json(spark, snippets, SNIPPETS))


def channel_rows(videos: DataFrame, verdicts: DataFrame, snippets: DataFrame) -> DataFrame:
    flat = snippets.select(F.explode("fetched").alias("videoId", "snippet"))
    known = videos.withColumn("_known", F.lit(True))
    rows = verdicts.join(known, "videoId", "left").join(flat, "videoId", "left")
    return rows.where(F.assert_true(F.col("_known"), F.concat(F.lit("no video "), F.col("videoId"))).isNull()).drop("_known")


def _fields(ddl: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T._parse_datatype_string(ddl))


def read_scores(scores: DataFrame, names: DataFrame) -> DataFrame:
    """Score rows and name rows of the same position; different lengths fail."""
    both = scores.join(names, "pos", "full_outer")
    return both.where(F.assert_true(F.col("name").isNotNull() & F.col("dur").isNotNull(), F.lit("scores and names differ in length")).isNull())


def split_entries(split_map: DataFrame) -> DataFrame:
    """Split maps as one row per entry: part, file, clip, split, start_sample, end_sample, md5_16."""
    return split_map.select(F.explode("parts").alias("p")).select("p.part", "p.file", F.explode("p.entries").alias("e")).select("part", "file", "e.*")


def silences(silence_map: DataFrame, rate: int = 24_000) -> DataFrame:
    """Silences of maps (path, duration, silences [[s, e]]) as clamped sample intervals: path, start, end."""
    rows = silence_map.select("path", "duration", F.explode("silences").alias("s"))
    edge = lambda i: F.bround(F.least(F.greatest(F.col("s")[i], F.lit(0.0)), F.col("duration")) * rate).cast("long")
    return rows.select("path", edge(0).alias("start"), edge(1).alias("end")).where("start < end")


def level_runs(levels: DataFrame, by: list[str], frame: str, level: str, below: float, at_least: float, fps: float = 30.0) -> DataFrame:
    """Silences of a level stream: runs of frames below ``below``, of at least ``at_least`` seconds: by, start, end (s)."""
    from corpusloom.operators.intervals import threshold_runs

    runs = threshold_runs(levels, by, [frame], F.col(level) < below, int(-(-at_least * fps // 1)))
    return runs.select(*by, (F.col("first_row") / fps).alias("start"), ((F.col("last_row") + 1) / fps).alias("end"))


def frame_count_ok(frames: Column, duration: Column, fps: float = 30.0, slack: int = 90) -> Column:
    return F.abs(frames - duration * fps) <= slack


def eval_losses(log: DataFrame) -> DataFrame:
    """Epoch and eval_loss of a training log (one text column, value)."""
    number = r"'{}':\s*'?([0-9.eE+-]+)'?"
    rows = log.select(F.regexp_extract("value", number.format("eval_loss"), 1).alias("l"), F.regexp_extract("value", number.format("epoch"), 1).alias("e"))
    return rows.where("l <> '' and e <> ''").select(F.col("e").cast("double").alias("epoch"), F.col("l").cast("double").alias("eval_loss"))


def probe_summary(log: DataFrame) -> DataFrame:
    """The USABLE=.. SKIPPED=.. MEDOFF=.. P95OFF=.. MAXOFF=.. line of a probe's log."""
    names = {"USABLE": "int", "SKIPPED": "int", "MEDOFF": "double", "P95OFF": "double", "MAXOFF": "double"}
    got = log.where(F.col("value").contains("USABLE="))
    return got.select(*(F.nullif(F.regexp_extract("value", rf"{k}=([0-9.]+)", 1), F.lit("")).cast(t).alias(k.lower()) for k, t in names.items()))


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSONL: ts, stage and the rest of the line as a JSON string."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    return raw.select(F.get_json_object("value", "$.ts").cast("double").alias("ts"), F.get_json_object("value", "$.stage").alias("stage"), F.col("value").alias("event"))


def throttled(temp: Column, mhz: Column) -> Column:
    """Hot or slow: a temperature of 83 or more, or under 1500 MHz."""
    return (F.max(temp) >= 83) | (F.min(mhz) < 1500)


def numbered_files(files: DataFrame, name: str, pattern: str = r"_ep(\d+)$") -> DataFrame:
    """Files with the number in their name, for sorting; those without one are left out."""
    n = F.regexp_extract(name, pattern, 1)
    return files.where(n != "").withColumn("number", n.cast("int"))
