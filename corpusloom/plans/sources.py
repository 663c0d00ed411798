"""Queries of readers and writers: cue files, logs, reports, score tables, names of files. Files stand in columns here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import reports
from corpusloom.plans.registry import query
from corpusloom.session import table
from corpusloom.sources import tables, vtt

# Cues by their lines: a time line opens one, its text goes up to a blank line.
_TIME = r"(?:[0-9]+:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]+)?"
_STAMP = "CASE WHEN len({0}) = 3 THEN CAST({0}[1] AS DOUBLE) * 3600 + CAST({0}[2] AS DOUBLE) * 60 + CAST({0}[3] AS DOUBLE) ELSE CAST({0}[1] AS DOUBLE) * 60 + CAST({0}[2] AS DOUBLE) END"
_CUES = rf"""
    l AS (SELECT doc_id, unnest(ls) AS raw, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents WHERE kind = 'vtt' AND text IS NOT NULL)),
    t AS (SELECT doc_id, i, trim(regexp_replace(raw, '[\t\x{{feff}}]', ' ', 'g'), ' ') AS line FROM l),
    f AS (SELECT *, regexp_matches(line, '^{_TIME}[ \t]*-->[ \t]*{_TIME}') AS is_time FROM t),
    c AS (SELECT *, count_if(is_time) OVER (PARTITION BY doc_id ORDER BY i) AS cue FROM f),
    b AS (SELECT *, count_if(line = '') OVER (PARTITION BY doc_id, cue ORDER BY i) AS blanks FROM c WHERE cue > 0),
    x AS (SELECT doc_id, cue, max(line) FILTER (WHERE is_time) AS stamp, coalesce(string_agg(line, ' ' ORDER BY i) FILTER (WHERE NOT is_time AND blanks = 0), '') AS text FROM b GROUP BY doc_id, cue),
    y AS (SELECT doc_id, CAST(cue - 1 AS INTEGER) AS cue_idx, text, string_split(replace(regexp_extract(stamp, '({_TIME})[ \t]*-->', 1), ',', '.'), ':') AS a, string_split(replace(regexp_extract(stamp, '-->[ \t]*({_TIME})', 1), ',', '.'), ':') AS z FROM x)"""
_PLAIN = "replace(translate(text, '{}', '{}'), '—', ' - ')".format(text.SMART[0], text.SMART[1].replace("'", "''"))


def _vtt(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", spread=True).where("kind = 'vtt' and text is not null")


@query(f"WITH {_CUES} SELECT doc_id, cue_idx, round({_STAMP.format('a')}, 3) AS start_s, round({_STAMP.format('z')}, 3) AS end_s, {_PLAIN} AS text FROM y")
def cue_texts(spark, d):
    """Cues with all lines of their text."""
    out = vtt.exploded(_vtt(spark, d), "doc_id", vtt.cues(F.col("text")))
    return out.select("doc_id", "cue_idx", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), "text")


@query(f"WITH {_CUES} SELECT doc_id, count(*) AS cues, round(min({_STAMP.format('a')}), 3) AS first_s, round(max({_STAMP.format('a')}), 3) AS last_s FROM y GROUP BY doc_id")
def cue_starts(spark, d):
    """S3: the starts of the cues of each file."""
    out = vtt.exploded(_vtt(spark, d), "doc_id", vtt.cues(F.col("text")))
    return out.groupBy("doc_id").agg(F.count("*").alias("cues"), F.round(F.min("start_s"), 3).alias("first_s"), F.round(F.max("start_s"), 3).alias("last_s"))


_MS = "CAST(round_even({0} * 1000, 0) AS BIGINT)"
_STAMPED = "printf('%02d:%02d:%02d.%03d', {0} // 3600000, {0} // 60000 % 60, {0} // 1000 % 60, {0} % 1000)"


@query("SELECT clip_id, 'WEBVTT' || chr(10) || chr(10) || '1' || chr(10) || " + _STAMPED.format(_MS.format("src_start")) + " || ' --> ' || " + _STAMPED.format(_MS.format("(src_start + seconds)"))
       + " || chr(10) || text || chr(10) AS vtt FROM clips WHERE text IS NOT NULL AND seconds IS NOT NULL AND src_start IS NOT NULL")
def cue_files(spark, d):
    """K3: each clip as a cue file of its own."""
    c = table(spark, d, "clips").where("text is not null and seconds is not null and src_start is not null")
    cue = F.struct(F.col("src_start").alias("start_s"), (F.col("src_start") + F.col("seconds")).alias("end_s"), "text")
    return c.select("clip_id", vtt.vtt_text(F.array(cue)).alias("vtt"))


@query("SELECT word_id, round(" + _MS.format("start_s") + " / 1000.0, 3) AS seconds, " + _STAMPED.format(_MS.format("start_s")) + " AS stamp FROM anchored_words WHERE start_s IS NOT NULL")
def stamps(spark, d):
    """F8: stamps written and read again."""
    w = table(spark, d, "anchored_words").where("start_s is not null").select("word_id", text.stamp_of(F.col("start_s")).alias("stamp"))
    return w.select("word_id", F.round(text.seconds_of(F.col("stamp")), 3).alias("seconds"), "stamp")


@query("SELECT event_id, CAST(user_id AS DOUBLE) AS epoch, value AS eval_loss FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL")
def logged_losses(spark, d):
    """Losses scraped from lines of a log."""
    e = table(spark, d, "events").where("value is not null and user_id is not null")
    line = F.format_string("{'eval_loss': '%s', 'epoch': '%s'}", F.col("value").cast("string"), F.col("user_id").cast("string"))
    got = tables.eval_losses(e.select(F.concat(line, F.lit(" #"), "event_id").alias("value")))
    return got.join(e.select("event_id", F.col("user_id").cast("double").alias("epoch"), F.col("value").alias("eval_loss")), ["epoch", "eval_loss"], "left_semi").join(
        e.select("event_id", F.col("user_id").cast("double").alias("_u"), F.col("value").alias("_v")), (F.col("epoch") == F.col("_u")) & (F.col("eval_loss") == F.col("_v"))
    ).select("event_id", "epoch", "eval_loss").distinct()


@query("SELECT DISTINCT CAST(user_id AS INTEGER) AS usable, CAST(event_id % 7 AS INTEGER) AS skipped, round(value, 2) AS medoff, round(value, 2) AS p95off, round(value, 2) AS maxoff FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL")
def probe_lines(spark, d):
    """The summary lines of probes."""
    e = table(spark, d, "events").where("value is not null and user_id is not null")
    v = F.format_string("%.2f", F.round("value", 2))
    line = F.concat(F.lit("USABLE="), "user_id", F.lit(" SKIPPED="), F.col("event_id") % 7, F.lit(" MEDOFF="), v, F.lit(" P95OFF="), v, F.lit(" MAXOFF="), v)
    return tables.probe_summary(e.select(line.alias("value"))).distinct()


@query("SELECT DISTINCT round(value, 3) AS median, round(value * 2, 3) AS p95, round(value * 3, 3) AS max, CAST(user_id AS INTEGER) AS corrected, CAST(NULL AS DOUBLE) AS threshold FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL")
def coverage_reports(spark, d):
    """The drift numbers of coverage reports."""
    e = table(spark, d, "events").where("value is not null and user_id is not null")
    drift = F.struct(F.col("value").alias("medianOffset"), (F.col("value") * 2).alias("p95"), (F.col("value") * 3).alias("maxOffsetSeconds"), F.col("user_id").alias("correctedCues"))
    both = F.struct(F.col("value").alias("medianOffset"), (F.col("value") * 2).alias("p95"), (F.col("value") * 3).alias("max"), F.col("user_id").alias("correctedCues"))
    rows = e.select(F.to_json(F.struct(both.alias("driftSelfCheck"))).alias("value"), drift.alias("_d"))
    return reports.coverage_numbers(rows).select(*(F.round(c, 3).alias(c) for c in ("median", "p95", "max")), "corrected", "threshold").distinct()


@query("""
    WITH e AS (SELECT event_type AS stage, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events)
    SELECT stage, count(*) AS events, CAST(min(event_id) AS DOUBLE) AS since, CAST(max(event_id) AS DOUBLE) AS until, round(max(value / 5), 6) AS hottest, round(min(value * 10), 6) AS slowest,
           max(value / 5) >= 83 OR min(value * 10) < 1500 AS throttled FROM e WHERE r <= 40 GROUP BY stage""")
def last_metrics(spark, d):
    """Over the 40 newest events of each type."""
    e = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.col("event_id").cast("double").alias("ts"), (F.col("value") / 5).alias("temp"), (F.col("value") * 10).alias("mhz"))
    out = reports.last_metrics(e, "stage")
    return out.withColumn("hottest", F.round("hottest", 6)).withColumn("slowest", F.round("slowest", 6))


@query(r"SELECT clip_id, CAST(regexp_extract(audio_file, '_([0-9]+)\.wav$', 1) AS INTEGER) AS number FROM clips WHERE regexp_matches(audio_file, '_([0-9]+)\.wav$')")
def numbered_files(spark, d):
    """Files by the number in their name."""
    return tables.numbered_files(table(spark, d, "clips"), "audio_file", r"_([0-9]+)\.wav$").select("clip_id", "number")


@query("SELECT clip_id AS pos, audio_file AS name, seconds AS dur FROM clips WHERE seconds IS NOT NULL AND audio_file IS NOT NULL")
def score_rows(spark, d):
    """Scores and names of the same position."""
    c = table(spark, d, "clips").where("seconds is not null and audio_file is not null").select(F.col("clip_id").alias("pos"), "audio_file", "seconds")
    return tables.read_scores(c.select("pos", F.col("seconds").alias("dur")), c.select("pos", F.col("audio_file").alias("name"))).select("pos", "name", "dur")


@query("""
    WITH w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem, pos ORDER BY word_id DESC) AS rn FROM anchored_words) WHERE rn = 1),
    g AS (SELECT stem AS path, end_s AS a, lead(start_s) OVER (PARTITION BY stem ORDER BY pos) AS b FROM w), m AS (SELECT stem AS path, max(end_s) AS duration FROM w GROUP BY stem),
    s AS (SELECT path, CAST(round_even(least(greatest(a, 0.0), duration) * 24000, 0) AS BIGINT) AS start, CAST(round_even(least(greatest(b, 0.0), duration) * 24000, 0) AS BIGINT) AS "end" FROM g JOIN m USING (path) WHERE a IS NOT NULL AND b IS NOT NULL)
    SELECT path, start, "end" FROM s WHERE start < "end\"""".replace('end\\"', 'end"'))
def silence_samples(spark, d):
    """The gaps between the words of a source as a silence map, in samples."""
    from pyspark.sql import Window

    from corpusloom.operators.titles import latest

    w = latest(table(spark, d, "anchored_words"), ["stem", "pos"], ["word_id"])
    gaps = w.select(F.col("stem").alias("path"), F.col("end_s").alias("a"), F.lead("start_s").over(Window.partitionBy("stem").orderBy("pos")).alias("b")).where("a is not null and b is not null")
    total = w.groupBy(F.col("stem").alias("path")).agg(F.max("end_s").alias("duration"))
    return tables.silences(gaps.join(total, "path").select("path", "duration", F.array(F.array("a", "b")).alias("silences")))


@query("""
    WITH r AS (SELECT user_id, value < 200 AS hit, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS island FROM r WHERE hit)
    SELECT user_id, round(min(i) / 30.0, 6) AS start, round((max(i) + 1) / 30.0, 6) AS "end" FROM g GROUP BY user_id, island HAVING count(*) >= 3""")
def quiet_runs(spark, d):
    """Runs of a level stream below a threshold, of a tenth of a second or more."""
    out = tables.level_runs(table(spark, d, "events"), ["user_id"], "event_id", "value", 200.0, 0.1)
    return out.select("user_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("SELECT doc_id, count_if(regexp_matches(l, '[^ ]')) AS lines FROM (SELECT doc_id, unnest(list_concat(string_split(text, chr(10)), string_split(text, chr(10)))) AS l FROM documents WHERE text IS NOT NULL) GROUP BY doc_id")
def flat_lists(spark, d):
    """Lists of lists as one list, counted with their places."""
    lines = F.split("text", "\n")
    docs = table(spark, d, "documents", spread=True).where("text is not null")
    flat = docs.select("doc_id", F.posexplode(tables.flat_sentences(F.array(lines, lines))).alias("i", "l"))
    return flat.groupBy("doc_id").agg(F.count_if(F.col("l").rlike("[^ ]")).alias("lines"))
