"""Queries over events, embeddings, orders: intervals, runs, nearest rows, codec frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators import gates, intervals, sft
from corpusloom.plans.registry import query
from corpusloom.session import table
from corpusloom.streaming.metrics import sessions

HALF_HOUR = 1800


def _events(spark: SparkSession, d: str) -> DataFrame:
    """events with s, seconds since 1970 (microseconds kept)."""
    e = table(spark, d, "events")
    return e.withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


@query("""
    WITH r AS (SELECT user_id, coalesce(value < 100, false) AS hit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
    g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS island FROM r WHERE hit),
    f AS (SELECT user_id, min(i) AS first_row, max(i) AS last_row, count(*) AS n FROM g GROUP BY user_id, island HAVING count(*) >= 3)
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY first_row) - 1 AS run, first_row, last_row, n FROM f""")
def threshold_runs(spark, d):
    """I1."""
    out = intervals.threshold_runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value") < 100, 3)
    return out.select("user_id", *(F.col(c).cast("long").alias(c) for c in ("run", "first_row", "last_row", "n")))


_UNION = """
    i AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 1800000000 AS e FROM events),
    w AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM i),
    g AS (SELECT *, sum(CASE WHEN reached IS NULL OR s > reached THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM w),
    u AS (SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS merged FROM g GROUP BY user_id, g)"""


def _spans(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("user_id", us.alias("start"), (us + HALF_HOUR * 1_000_000).alias("end"))


@query("WITH " + _UNION + " SELECT user_id, s AS start, e AS \"end\", merged FROM u")
def interval_union(spark, d):
    """I2."""
    return intervals.union(_spans(spark, d), ["user_id"])


@query(
    "WITH " + _UNION + """,
    n AS (SELECT user_id, e AS start, lead(s) OVER (PARTITION BY user_id ORDER BY s) AS "end" FROM u) SELECT user_id, start, "end" FROM n WHERE "end" > start"""
)
def interval_complement(spark, d):
    """Between each user's first and last interval."""
    s = _spans(spark, d)
    return intervals.complement(s, ["user_id"], s.groupBy("user_id").agg(F.min("start").alias("lo"), F.max("end").alias("hi")))


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 150 MINUTE THEN 0 ELSE 1 END AS new, event_id FROM events),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM g)
    SELECT user_id, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY user_id, segment""")
def session_gaps(spark, d):
    """A gap of 2.5 hours is a wall between segments; the batch form of the streaming operator."""
    e = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = sessions(e, "user_id", "at", "150 minutes", "1 day", F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return out.select("user_id", "events", "first_ts", "last_ts")


@query("""
    WITH p AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'), x AS (SELECT event_id AS error_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error'),
    c AS (SELECT p.event_id, error_id, abs(p.t - x.t) AS dist, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.t - x.t), error_id) AS rn
          FROM p JOIN x ON p.user_id = x.user_id AND abs(p.t - x.t) <= 21600000000)
    SELECT event_id, error_id, dist AS micros FROM c WHERE rn = 1""")
def nearest_snap(spark, d):
    """The error nearest to each purchase of the same user, at most 6 hours away."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, d, "events")
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", us.alias("t"))
    x = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), us.alias("u"))
    out = intervals.nearest(p, x, ["user_id"], "event_id", F.col("t"), F.col("u"), F.col("u"), 21_600_000_000, "error_id", 21_600_000_000)
    return out.select("event_id", "error_id", F.col("distance").cast("long").alias("micros"))


@query("""
    WITH x AS (SELECT user_id, epoch_us(ts) AS a, epoch_us(ts) + 1800000000 AS b FROM events WHERE event_type = 'error')
    SELECT event_id FROM events e WHERE event_type <> 'error' AND NOT EXISTS (SELECT 1 FROM x WHERE x.user_id = e.user_id AND epoch_us(e.ts) < x.b AND epoch_us(e.ts) + 1800000000 > x.a)""")
def interval_anti(spark, d):
    """Events whose half hour meets that of no error."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, d, "events").select("event_id", "event_type", "user_id", us.alias("start"), (us + HALF_HOUR * 1_000_000).alias("end"))
    return intervals.without_excluded(e.where("event_type <> 'error'"), e.where("event_type = 'error'"), ["user_id"], 3_600_000_000).select("event_id")


@query("""
    WITH x AS (SELECT event_id AS span_id, user_id, epoch_us(ts) AS a, epoch_us(ts) + 21600000000 AS b FROM events WHERE event_type = 'error'),
    c AS (SELECT event_id, user_id, event_type, epoch_us(ts) + 900000000 AS m FROM events)
    SELECT span_id, string_agg(event_type, ' ' ORDER BY event_id) AS text, count(*) AS units FROM x JOIN c ON x.user_id = c.user_id AND a <= m AND m < b GROUP BY span_id""")
def midpoint_assign(spark, d):
    """The types of events whose midpoint lies in the six hours after an error, in order."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, d, "events")
    units = e.select("user_id", "event_id", F.col("event_type").alias("text"), us.alias("start"), (us + HALF_HOUR * 1_000_000).alias("end"))
    spans = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("span_id"), us.alias("a"), (us + 21_600_000_000).alias("b"))
    return intervals.texts_by_midpoint(units, spans, ["user_id"], "event_id", 21_600_000_000).select("span_id", "text", "units")


@query("""
    WITH k AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
    SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM k""")
def failure_streaks(spark, d):
    """W9."""
    return gates.failure_streaks(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") != "error").select("event_id", "streak")


@query("""
    WITH m AS (SELECT event_type AS name, quantile_cont(CAST(value AS DOUBLE), 0.5) AS med, quantile_cont(CAST(value AS DOUBLE), 0.9) AS p90 FROM events GROUP BY event_type),
    a AS (SELECT quantile_cont(CAST(value AS DOUBLE), 0.5) AS med, quantile_cont(CAST(value AS DOUBLE), 0.9) AS p90 FROM events)
    SELECT m.name, round(abs(m.med - a.med) / 2.0 + abs(m.p90 - a.p90) / 0.1, 6) AS distance FROM m, a""")
def epoch_distance(spark, d):
    """Event types as epochs against all events as the reference."""
    e = table(spark, d, "events")
    e = e.select(F.col("event_type").alias("name"), "value")
    of = lambda by: stats.order_statistics(e, by, "value", {}, {"med": 0.5, "p90": 0.9})
    rows = gates.epoch_distance(of(["name"]), of([]), {"med": 2.0, "p90": 0.1})
    return rows.select("name", F.round("distance", 6).alias("distance"))


_QUANT = "list_transform(embedding[1:63], lambda x: CAST(floor((CAST(x AS DOUBLE) + 1) * 2000) AS INTEGER))"


def _codes(spark: SparkSession, d: str) -> DataFrame:
    """Quantised vectors as three codebooks of 9 frames."""
    e = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 63), lambda x: F.pmod(F.floor((x.cast("double") + 1) * 2000).cast("int"), F.lit(sft.CODES))).alias("q"))
    return e.select("vec_id", "q", F.slice("q", 1, 9).alias("b0"), F.slice("q", 10, 18).alias("b1"), F.slice("q", 28, 36).alias("b2"))


@query(f"""
    WITH q AS (SELECT vec_id, list_transform({_QUANT}, lambda x: ((x % 4096) + 4096) % 4096) AS q FROM embeddings)
    SELECT vec_id, CAST(list_sum(q) + 9 * 7 * 128266 + 9 * 4096 * 21 AS BIGINT) AS checksum, true AS same FROM q""")
def slot_roundtrip(spark, d):
    """Interleaved to 7 slots a frame and back."""
    rows = _codes(spark, d)
    ids = sft.interleave([F.col("b0"), F.col("b1"), F.col("b2")])
    rows = rows.withColumn("ids", ids)
    b0, b1, b2 = sft.deinterleave(F.col("ids"))
    same = (b0 == F.col("b0")) & (b1 == F.col("b1")) & (b2 == F.col("b2"))
    return rows.select("vec_id", F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("checksum"), same.alias("same"))


@query("""
    WITH q AS (SELECT vec_id, list_transform(embedding[1:63], lambda x: CAST(floor(CAST(x AS DOUBLE) * 4) AS INTEGER)) AS q FROM embeddings),
    f AS (SELECT vec_id, q, unnest(range(0, 9)) AS i FROM q)
    SELECT vec_id, count(*) FILTER (WHERE i = 0 OR q[i * 7 + 1] <> q[(i - 1) * 7 + 1]) AS frames FROM f GROUP BY vec_id""")
def frame_dedup(spark, d):
    """Frames left when those that repeat the first code are dropped."""
    q = F.transform(F.slice("embedding", 1, 63), lambda x: F.floor(x.cast("double") * 4).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", (F.size(sft.without_repeated_frames(q)) / sft.SLOTS).cast("long").alias("frames"))


@query("""
    WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, len(embedding))) AS i FROM embeddings),
    c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY label, i)
    SELECT vec_id, x.label, round(sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))), 4) AS cosine FROM x JOIN c ON x.label = c.label AND x.i = c.i GROUP BY vec_id, x.label""")
def centroid_verify(spark, d):
    """X2 (described, not implemented, where the other operators come from): cosine of each vector with its label's centroid."""
    e = table(spark, d, "embeddings")
    x = e.select("label", F.posexplode("embedding").alias("i", "v"))
    c = x.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m")).groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    v, m = F.col("embedding"), F.col("c")
    return e.join(c, "label").select("vec_id", "label", F.round(dot(v, m) / (F.sqrt(dot(v, v)) * F.sqrt(dot(m, m))), 4).alias("cosine"))


@query("""
    WITH b AS (SELECT user_id, CAST(floor(value / 250) * 250 AS BIGINT) AS bin FROM events WHERE value IS NOT NULL GROUP BY ALL)
    SELECT bin, count(*) AS chunks FROM b GROUP BY bin HAVING count(*) > (SELECT count(DISTINCT user_id) FROM events) / 3.0""")
def ring_bins(spark, d):
    """250-wide bins that more than a third of all users reach."""
    out = gates.ring_bins(table(spark, d, "events"), "user_id", "value")
    return out.select(F.col("bin").cast("long").alias("bin"), "chunks")
