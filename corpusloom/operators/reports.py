"""Smaller joins, picks and summaries: checked joins, unions of parts, clusters, tails, numbering, cost shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.stats import order_statistics
from corpusloom.operators.intervals import complement, global_running
from corpusloom.operators.select import even_spread


def checked_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each row of ``left`` with its row of ``right``; a key that is missing there fails the query."""
    known = right.withColumn("_known", F.lit(True))
    rows = left.join(known, key, "left")
    return rows.where(F.assert_true(F.col("_known"), F.concat(F.lit("no match for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).isNull()).drop("_known")


def first_match(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, order: list[str]) -> DataFrame:
    """Rows of ``left`` with the first row of ``right`` (by ``order``) whose key expression is equal; no match, no row.

    ``right`` is cut to one row per key before the join, by an aggregate."""
    rest = right.columns
    one = right.withColumn("_k", right_key).groupBy("_k").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return left.withColumn("_k", left_key).join(one, "_k").select(*left.columns, *(F.col(f"_r.{c}") for c in rest if c not in left.columns))


def tagged_union(parts: dict[str, DataFrame], column: str = "part_set") -> DataFrame:
    """Several tables of one shape as one, each row with its part set; columns are matched by name."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(column, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def slices(whole: DataFrame, offsets: DataFrame, key: str) -> DataFrame:
    """Parts cut out again by recorded offsets: ``whole`` (key, text), ``offsets`` (key, name, start, end; from 0, half open)."""
    return whole.join(offsets, key).select(key, "name", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))


def spread_subset(df: DataFrame, order: list[str], size: str, need: float) -> DataFrame:
    """An evenly spread subset of about ``need`` in all: the share of rows is need / total, at most all of them."""
    share = df.agg(F.least(F.lit(1.0), F.lit(float(need)) / F.sum(size)).alias("s")).first()[0]
    return even_spread(df, order, share or 0.0).where("split = 'eval'").drop("split")


def seed_set(df: DataFrame, order: list[str], seconds: str, low: float = 900.0, high: float = 2700.0, shortest: float = 3.5) -> DataFrame:
    """The seed set of a voice: clips of ``shortest`` seconds or more, evenly spread down to ``high`` seconds in all; a set
    of less than ``low`` seconds is too small and fails. (Its pauses are cut with ``audio.frames.cap_pauses``, 0.25 to 0.20 s.)"""
    rows = df.where(F.col(seconds) >= shortest)
    total = rows.agg(F.sum(seconds)).first()[0] or 0.0
    if total < low:
        raise ValueError(f"only {total / 60:.1f} minutes for a seed set of {low / 60:g}")
    return spread_subset(rows, order, seconds, high)


def speech_between(silences: DataFrame, by: list[str], total: DataFrame, at_least: float) -> DataFrame:
    """Speech is what lies between ALL silences; short silences are then dropped: (speech, kept silences) in one
    table with kind. ``total``: by, lo, hi."""
    speech = complement(silences, by, total).withColumn("kind", F.lit("speech"))
    kept = silences.where(F.col("end") - F.col("start") >= at_least).select(*by, "start", "end").withColumn("kind", F.lit("gap"))
    return speech.unionByName(kept)


def banded_pick(df: DataFrame, length: Column, order: list[str], n: int, first: tuple[int, int] = (200, 360), then: tuple[int, int] = (120, 199)) -> DataFrame:
    """Up to ``n`` rows in order: those of the first band of lengths, topped up from the second."""
    band = F.when(length.between(*first), 0).when(length.between(*then), 1)
    return df.withColumn("_band", band).where(F.col("_band").isNotNull()).orderBy("_band", *order).limit(n).drop("_band")


def length_ok(seconds: Column, longest: float, shortest: float = 1.5, slack: float = 0.0) -> Column:
    """P3."""
    return (seconds >= shortest) & (seconds <= longest + slack)


def probe_friendly(text: Column, least: int = 10, head: int = 6) -> Column:
    """Enough words, no digit among the first ones."""
    return tx.let(tx.tokens(text), lambda w: (F.size(w) >= least) & ~F.exists(F.slice(w, 1, head), lambda x: x.rlike("[0-9]")))


def apply_names(df: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """F16: ``text`` with each token that has a row in ``names`` (token, name) replaced, its punctuation kept."""
    parts = df.select(key, F.posexplode(F.split(text, " ")).alias("_i", "_w"))
    core = F.regexp_replace("_w", r"^[^A-Za-z]+|[^A-Za-z'\-]+$", "")
    joined = parts.withColumn("_c", core).join(names.select(F.col("token").alias("_c"), "name"), "_c", "left")
    said = F.when(F.col("name").isNotNull(), F.replace("_w", "_c", "name")).otherwise(F.col("_w"))
    rebuilt = joined.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_i", said.alias("w")))), lambda x: x["w"]), " ").alias(text))
    return df.drop(text).join(rebuilt, key, "left")


def clusters(df: DataFrame, hz: str, strength: str, width: float, per: int = 4) -> DataFrame:
    """A10: bin, n, strongest, exemplars (the ``per`` strongest) of each frequency bin.

    A bin is salted: each share keeps its own strongest, so what is put together per bin is bounded."""
    b = (F.floor(F.col(hz) / width) * width).alias("bin")
    rows = df.where(F.col(hz).isNotNull()).select(b, F.col(strength).alias("_v"), F.pmod(F.xxhash64(hz, strength), F.lit(32)).alias("_salt"))
    best = rows.withColumn("_r", F.row_number().over(Window.partitionBy("bin", "_salt").orderBy(F.desc("_v")))).where(F.col("_r") <= per)
    top = best.groupBy("bin").agg(F.slice(F.sort_array(F.collect_list("_v"), asc=False), 1, per).alias("exemplars"))
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.max("_v").alias("strongest")).join(top, "bin")


def density(df: DataFrame, at: str, span: float = 600.0) -> DataFrame:
    """A10: rows per tumbling span."""
    return df.where(F.col(at).isNotNull()).groupBy((F.floor(F.col(at) / span) * span).alias("from_s")).agg(F.count("*").alias("n"))


def model_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """N, median, p90, most and population deviation per group; groups may be of any size, a group without values has nulls."""
    base = df.groupBy(*by).agg(F.count(value).alias("n"), F.max(value).alias("most"), F.stddev_pop(value).alias("deviation"))
    points = order_statistics(df, by, value, {}, {"median": 0.5, "p90": 0.9})
    same = F.lit(True)
    for k in by:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return base.alias("a").join(points.alias("b"), same, "left").select(*(f"a.{k}" for k in by), "n", "median", "p90", "most", "deviation")


def self_tail(df: DataFrame, trailing: str, gap: float) -> DataFrame:
    """The part of each trailing silence that is the clip's own, when ``gap`` seconds were baked in; not below 0."""
    return df.withColumn("self_tail", F.greatest(F.lit(0.0), F.col(trailing) - gap))


def assembly_gap(internal: Column, tail: Column, share: float = 0.75) -> Column:
    """X5 (described only): the gap to add so that tail and gap make ``share`` of the inner pause; not below 0."""
    return F.greatest(F.lit(0.0), share * internal - tail)


def cost_shares(chunks: DataFrame, by: list[str]) -> DataFrame:
    """X4 (described only): accepted, rejected and idle share of each batch cycle; rows: by, seconds, state."""
    total = F.sum("seconds")
    part = lambda s: F.round(F.try_divide(F.sum(F.when(F.col("state") == s, F.col("seconds")).otherwise(0.0)), total), 6).alias(s)
    return chunks.groupBy(*by).agg(total.alias("seconds"), part("accepted"), part("rejected"), part("idle"))


def numbered_names(df: DataFrame, order: list[str], prefix: str, digits: int = 6) -> DataFrame:
    """Name: the prefix and a zero-padded number, from 1, over one global order."""
    rows = global_running(df.withColumn("_one", F.lit(1)), order, "_one")
    return rows.withColumn("name", F.concat(F.lit(prefix), F.lpad((F.col("row") + 1).cast("string"), digits, "0"))).drop("before", "total", "row", "total_rows", "_one")


def last_metrics(metrics: DataFrame, by: str, n: int = 40) -> DataFrame:
    """Over the ``n`` newest events of each stage: events, first and last time, hottest, slowest, throttled."""
    w = Window.partitionBy(by).orderBy(F.desc("ts"))
    recent = metrics.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    out = recent.groupBy(by).agg(F.count("*").alias("events"), F.min("ts").alias("since"), F.max("ts").alias("until"), F.max("temp").alias("hottest"), F.min("mhz").alias("slowest"))
    return out.withColumn("throttled", (F.col("hottest") >= 83) | (F.col("slowest") < 1500))


def narration_runs(cues: DataFrame, by: str, least: float = 15.0) -> DataFrame:
    """X1 (described only): runs of cues outside quotations, of ``least`` seconds: by, run, start, end.

    cues: by, cue_idx, start, end, in_quote."""
    w = Window.partitionBy(by).orderBy("cue_idx")
    rows = cues.withColumn("_i", F.row_number().over(w)).where(~F.col("in_quote"))
    islands = rows.withColumn("_g", F.col("_i") - F.row_number().over(w)).groupBy(by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return islands.where(F.col("end") - F.col("start") >= least).select(by, "start", "end")


def coverage_numbers(report: DataFrame) -> DataFrame:
    """The drift numbers of a coverage report (one JSON text column, value) under either of their spellings; the
    largest drift and one of the medians must be there."""
    pick = lambda *names: F.coalesce(*(F.get_json_object("value", f"$.driftSelfCheck.{n}") for n in names)).cast("double")
    rows = report.select(
        pick("median", "medianOffset", "medianOffsetSeconds").alias("median"), pick("p95", "p95Offset", "p95OffsetSeconds").alias("p95"), pick("max", "maxOffset", "maxOffsetSeconds").alias("max"),
        pick("correctedCues").cast("int").alias("corrected"), pick("correctionThresholdSeconds").alias("threshold"),
    )
    return rows.where(F.assert_true(F.col("max").isNotNull() & F.col("median").isNotNull(), F.lit("no drift numbers")).isNull())
