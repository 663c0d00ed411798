"""Timed text as Column expressions over whole files: cues, rolling captions, writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import rolling_dedupe, seconds_of, smart_chars, squeeze, stamp_of

_TIME = r"(?:[0-9]+:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]+)?"
_CUE = rf"({_TIME})[ \t]*-->[ \t]*({_TIME})"
FALLBACK = "NOTE asr-fallback"


def read_texts(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """path, text: one row per file, read whole."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", suffix).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n")


def cues(text: Column, drop_fallback: bool = True, keep_empty: bool = True, plain: bool = True) -> Column:
    """Cues (start_s, end_s, text) in order, from mm:ss or hh:mm:ss stamps; settings after the end are ignored.

    A cue's text is its lines up to a blank one, joined by blanks. With ``drop_fallback`` the cue after a line that
    begins with FALLBACK is left out. ``plain``: typographic quotes and dashes as plain ones. Null gives null, text
    without cues an empty list."""
    start = F.struct(F.array().cast("array<struct<start_s:double,end_s:double,text:string,dropped:boolean>>").alias("done"), F.lit(False).alias("inside"), F.lit(False).alias("tagged"))

    def step(acc: Column, raw: Column) -> Column:
        line = F.trim(F.regexp_replace(raw, r"[\t\x{feff}]", " "))
        is_time, is_tag, blank = line.rlike("^" + _CUE), line.startswith(FALLBACK), line == ""
        new = F.struct(
            seconds_of(F.regexp_extract(line, _CUE, 1)).alias("start_s"), seconds_of(F.regexp_extract(line, _CUE, 2)).alias("end_s"), F.lit("").alias("text"), acc["tagged"].alias("dropped")
        )
        last = F.element_at(acc["done"], -1)
        longer = F.array_append(
            F.slice(acc["done"], 1, F.size(acc["done"]) - 1),
            F.struct(last["start_s"].alias("start_s"), last["end_s"].alias("end_s"), F.trim(F.concat_ws(" ", last["text"], line)).alias("text"), last["dropped"].alias("dropped")),
        )
        more = acc["inside"] & ~blank & ~is_time & ~is_tag
        done = F.when(is_time, F.array_append(acc["done"], new)).when(more, longer).otherwise(acc["done"])
        return F.struct(done.alias("done"), ((is_time | acc["inside"]) & ~blank & ~is_tag).alias("inside"), F.when(is_time, False).otherwise(acc["tagged"] | is_tag).alias("tagged"))

    found = F.aggregate(_lines(text), start, step, lambda acc: acc["done"])
    if drop_fallback:
        found = F.filter(found, lambda c: ~c["dropped"])
    say = (lambda t: smart_chars(t)) if plain else (lambda t: t)
    out = F.transform(found, lambda c: F.struct(c["start_s"].alias("start_s"), c["end_s"].alias("end_s"), say(c["text"]).alias("text")))
    return out if keep_empty else F.filter(out, lambda c: c["text"] != "")


def block_cues(text: Column) -> Column:
    """Cues of blank-line blocks, only those with text; strict hh:mm:ss.mmm stamps. Much cheaper than ``cues``."""
    strict = r"([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}) --> ([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})"
    blocks = F.filter(F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"\n[ \t]*\n"), lambda b: b.rlike(strict))
    body = lambda b: squeeze(F.regexp_replace(b, r"(?s)^.*?" + strict + r"[^\n]*(?:\n|$)", ""))
    made = F.transform(blocks, lambda b: F.struct(seconds_of(F.regexp_extract(b, strict, 1)).alias("start_s"), seconds_of(F.regexp_extract(b, strict, 2)).alias("end_s"), body(b).alias("text")))
    return F.filter(made, lambda c: c["text"] != "")


def exploded(df: DataFrame, key: str, cue_array: Column) -> DataFrame:
    """key, cue_idx, start_s, end_s, text."""
    return df.select(F.col(key), F.posexplode(cue_array).alias("cue_idx", "c")).select(key, "cue_idx", "c.start_s", "c.end_s", "c.text")


def caption_lines(text: Column) -> Column:
    """The text lines of a rolling caption file: no header, stamps, notes or tags, none blank."""
    bare = F.transform(_lines(text), lambda x: F.trim(F.regexp_replace(x, "\t", " ")))
    kept = F.filter(bare, lambda x: (x != "") & (x != "WEBVTT") & ~x.rlike(r"^[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3} --> ") & ~x.rlike("^(Kind:|Language:|NOTE|align:)"))
    return F.filter(F.transform(kept, lambda x: F.trim(F.regexp_replace(x, "<[^>]+>", ""))), lambda x: x != "")


def caption_text(text: Column, most: int | None = None) -> Column:
    """A rolling caption file as running text: a line that equals, or ends, the line kept last is left out. The whole
    text unless ``most`` characters are asked for."""
    joined = F.array_join(rolling_dedupe(caption_lines(text)), " ")
    return joined if most is None else F.substring(joined, 1, most)


def vtt_text(cue_array: Column) -> Column:
    """K3: a VTT file from cues in order, numbered from 1."""
    body = F.transform(cue_array, lambda c, i: F.concat((i + 1).cast("string"), F.lit("\n"), stamp_of(c["start_s"]), F.lit(" --> "), stamp_of(c["end_s"]), F.lit("\n"), c["text"], F.lit("\n")))
    return F.concat(F.lit("WEBVTT\n\n"), F.array_join(body, "\n"))
