"""Queries over videos, verdicts, descriptions and lifetime_daily."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats, text
from corpusloom.operators import gates, joins, select, titles
from corpusloom.plans.registry import query
from corpusloom.session import table

_LATEST = """
    v AS (SELECT video_id, channel, format, published_at FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY loaded_at DESC) AS rn FROM videos) WHERE rn = 1),
    d AS (SELECT video_id, verdict_id, titles, lifetime FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY loaded_at DESC, verdict_id DESC) AS rn FROM verdicts) WHERE rn = 1)"""
_TIERS = (
    _LATEST
    + """,
    r AS (SELECT d.*, v.channel, v.format, v.published_at,
                 CASE WHEN d.lifetime.ctr IS NOT NULL AND coalesce(d.lifetime.impressions, 0) >= 1000 THEN d.lifetime.ctr END AS ctr FROM d JOIN v USING (video_id)),
    p AS (SELECT video_id, (rank() OVER (PARTITION BY channel, format ORDER BY ctr) - 1) * 100.0 / count(*) OVER (PARTITION BY channel, format) AS pct FROM r WHERE ctr IS NOT NULL),
    t AS (SELECT r.*, CASE WHEN pct IS NULL THEN 'unrated' WHEN pct >= 90 THEN 'top-decile' WHEN pct >= 70 THEN 'strong' WHEN pct >= 30 THEN 'typical' ELSE 'weak' END AS tier
          FROM r LEFT JOIN p USING (video_id))"""
)


def _nested(step: str, start: str, times: int) -> str:
    """``step`` with {} applied ``times`` times, one subquery a time so that the text stays short."""
    out = f"(SELECT {start} AS t)"
    for _ in range(times):
        out = f"(SELECT {step.format('t')} AS t FROM {out})"
    return f"(SELECT t FROM {out})"


# The same patterns as the functions of functions.text, in DuckDB's dialect.
_MARK = r"\s*(?:[|\-–]\s*)?(?:(?:P(?:ar)?t\.?|Podcast|Episode|Ep\.?|#)\s*\d+[^|]*|P\d+)\s*$"
_STEP = rf"CASE WHEN regexp_replace(regexp_replace({{0}}, '{_MARK}', '', 'i'), '[ |\-–]+$', '') = '' THEN {{0}} ELSE regexp_replace(regexp_replace({{0}}, '{_MARK}', '', 'i'), '[ |\-–]+$', '') END"


def _clean_title_sql(title: str) -> str:
    return f"trim({_nested(_STEP, rf'''regexp_replace({title}, '\s*#shorts?\b', '', 'gi')''', 8)})"


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, d, "videos"), table(spark, d, "verdicts"), table(spark, d, "descriptions", spread=True)


@query("WITH " + _LATEST + " SELECT v.video_id, v.channel, v.format, v.published_at FROM v")
def latest_videos(spark, d):
    """One row per key of a table that delivers some keys again."""
    v = table(spark, d, "videos").select("video_id", "channel", "format", "published_at", "loaded_at")
    return titles.latest(v, ["video_id"], ["loaded_at"]).drop("loaded_at")


@query("WITH " + _TIERS + " SELECT video_id, channel, format, tier FROM t")
def tier_by_group(spark, d):
    """Tiers within (channel, format)."""
    return titles.title_rows(*_tables(spark, d)).select("video_id", "channel", "format", "tier")


@query("WITH " + _TIERS + " SELECT channel, format, tier, count(*) AS videos FROM t GROUP BY channel, format, tier")
def tier_counts(spark, d):
    """A4."""
    return tier_by_group(spark, d).groupBy("channel", "format", "tier").agg(F.count("*").alias("videos"))


_BOILER = text.BOILERPLATE.replace("'", "''")
# The rows of title_examples and title_backfill: the latest verdicts with title and content, as cleaned there.
_KEY = r"lower(trim(regexp_replace({0}, '[^\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}\x{{200c}}\x{{200d}}]+', ' ', 'g')))"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _content_sql() -> str:
    lines = rf"list_filter(list_transform(string_split_regex(s.snippet.description, '\r\n|\n|\r'), lambda x: regexp_replace(x, '\s+$', '')), lambda x: NOT regexp_matches(x, '{_BOILER}', 'i'))"
    page = _STRIP.format(rf"regexp_replace(array_to_string({lines}, chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')")
    first, key = _KEY.format("split_part(page, chr(10), 1)"), _KEY.format("title")
    rest = _STRIP.format(r"regexp_replace(page, '^[^\n]*\n', '')")
    return rf""",
    a AS (SELECT t.video_id, verdict_id, t.channel, format, tier, published_at, {_clean_title_sql('titles[len(titles)]')} AS title, coalesce({page}, '') AS page
          FROM t JOIN descriptions s ON s.video_id = t.video_id WHERE s.snippet IS NOT NULL AND len(titles) > 0 AND titles[len(titles)] IS NOT NULL),
    k AS (SELECT *, {first} AS f, {key} AS g FROM a),
    c AS (SELECT *, CASE WHEN f <> '' AND g <> '' AND (starts_with(f, g) OR starts_with(g, f)) THEN CASE WHEN contains(page, chr(10)) THEN {rest} ELSE '' END ELSE page END AS content FROM k)"""


_EXAMPLES = "WITH " + _TIERS + _content_sql()


@query(
    _EXAMPLES + """,
    e AS (SELECT *, row_number() OVER (ORDER BY published_at, video_id) - 1 AS i, count(*) OVER () AS n FROM c WHERE length(content) >= 60)
    SELECT video_id, verdict_id, channel, format, tier, title, CAST(length(content) AS INTEGER) AS content_chars, CASE WHEN i >= n - greatest(1, round_even(n * 0.08, 0)) THEN 'eval' ELSE 'train' END AS split, 3 AS turns FROM e"""
)
def title_examples(spark, d):
    """Text examples with tier and split, as chat messages; the flagship."""
    rows = titles.messages(titles.examples(*_tables(spark, d)))
    return rows.select("video_id", "verdict_id", "channel", "format", "tier", "title", F.length("content").alias("content_chars"), "split", F.size("messages").alias("turns"))


@query(_EXAMPLES + " SELECT video_id, channel, format, title, CAST(length(content) AS INTEGER) AS content_chars FROM c WHERE length(content) < 60")
def title_backfill(spark, d):
    """What is left to describe."""
    return titles.backfill(*_tables(spark, d))


@query(f"SELECT verdict_id, {_clean_title_sql('titles[len(titles)]')} AS title FROM verdicts WHERE len(titles) > 0 AND titles[len(titles)] IS NOT NULL")
def clean_titles(spark, d):
    """P7."""
    v = table(spark, d, "verdicts").where((F.size("titles") > 0) & F.element_at("titles", -1).isNotNull())
    return v.select("verdict_id", text.clean_title(F.element_at("titles", -1)).alias("title"))




@query(rf"""
    WITH l AS (SELECT video_id, unnest(string_split_regex(snippet.description, '\r\n|\n|\r')) AS line FROM descriptions WHERE snippet.description IS NOT NULL)
    SELECT video_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(line, '{_BOILER}', 'i')) AS dropped FROM l GROUP BY video_id""")  # fmt: skip
def boilerplate_filter(spark, d):
    """P5: lines of each description, and those that are links, labels or plugs."""
    lines = F.split("snippet.description", r"\r\n|\n|\r")
    rows = table(spark, d, "descriptions", spread=True).where(F.col("snippet.description").isNotNull())
    bad = F.filter(lines, lambda x: x.rlike("(?i)" + text.BOILERPLATE))
    return rows.select("video_id", F.size(lines).cast("long").alias("lines"), F.size(bad).cast("long").alias("dropped"))


@query(r"""
    WITH k AS (SELECT video_id, trim(regexp_replace(lower(split_part(snippet.description, chr(10), 1)), '[^\p{L}\p{N}\p{M}\p{Pc}\x{200c}\x{200d}]+', ' ', 'g')) AS f,
                      trim(regexp_replace(lower(snippet.title), '[^\p{L}\p{N}\p{M}\p{Pc}\x{200c}\x{200d}]+', ' ', 'g')) AS t FROM descriptions)
    SELECT video_id, f <> '' AND t <> '' AND (starts_with(f, t) OR starts_with(t, f)) AS echo FROM k WHERE f IS NOT NULL AND t IS NOT NULL""")
def title_echo(spark, d):
    """Does the first line of a description echo its title."""
    rows = table(spark, d, "descriptions", spread=True).where(F.col("snippet.description").isNotNull() & F.col("snippet.title").isNotNull())
    f, t = text.title_key(F.split("snippet.description", "\n")[0]), text.title_key(F.col("snippet.title"))
    return rows.select("video_id", ((f != "") & (t != "") & (f.startswith(t) | t.startswith(f))).alias("echo"))


@query(rf"""
    SELECT video_id, CASE WHEN regexp_matches(snippet.description, '{gates.META.replace("'", "''")}', 'i') THEN 'meta-commentary'
                          WHEN length(trim(snippet.description)) < 150 AND strlen(snippet.title) >= 60 THEN 'too short' END AS reason
    FROM descriptions WHERE snippet.description IS NOT NULL""")  # fmt: skip
def junk_audit(spark, d):
    """Descriptions as summaries, the bytes of the title as the size of their source."""
    rows = table(spark, d, "descriptions", spread=True).where(F.col("snippet.description").isNotNull())
    return rows.select("video_id", gates.junk_reason(F.col("snippet.description"), F.octet_length("snippet.title"), 150, 60).alias("reason"))


@query("""
    WITH v AS (SELECT *, row_number() OVER (ORDER BY published_at, video_id, loaded_at) - 1 AS i, count(*) OVER () AS n FROM videos)
    SELECT video_id, loaded_at, CASE WHEN i >= n - greatest(1, round_even(n * 0.08, 0)) THEN 'eval' ELSE 'train' END AS split FROM v""")
def chrono_split(spark, d):
    """L6."""
    return select.chronological_split(table(spark, d, "videos"), ["published_at", "video_id", "loaded_at"], 0.08).select("video_id", "loaded_at", "split")


@query("""
    WITH s AS (SELECT verdict_id, titles, unnest(range(1, len(titles))) AS change FROM verdicts WHERE len(titles) > 1),
    p AS (SELECT verdict_id, change, titles[change] AS a, titles[change + 1] AS b FROM s)
    SELECT verdict_id, CAST(change AS INTEGER) AS change, round(CASE WHEN length(a) = 0 OR length(b) = 0 THEN 1.0
           ELSE levenshtein(lower(a), lower(b)) / CAST(greatest(length(a), length(b)) AS DOUBLE) END, 6) AS ratio FROM p WHERE a IS NOT NULL AND b IS NOT NULL AND a = regexp_replace(a, '[^ -~]', '', 'g') AND b = regexp_replace(b, '[^ -~]', '', 'g')""")
def title_edit_ratio(spark, d):
    """F9 over the history of titles in plain characters, the part of title_edit_ratio_all that the SQL can check (its engine counts the distance of other characters in bytes)."""
    plain = ~F.col("before").rlike("[^ -~]") & ~F.col("after").rlike("[^ -~]")
    return _edit_ratios(titles.title_changes(table(spark, d, "verdicts")).where(plain))


@query()
def title_edit_ratio_all(spark, d):
    """F9 over every step of the history of titles, in characters of any script; a step from or to a null title has no ratio and gives no row."""
    return _edit_ratios(titles.title_changes(table(spark, d, "verdicts")).where(F.col("before").isNotNull() & F.col("after").isNotNull()))


def _edit_ratios(changes: DataFrame) -> DataFrame:
    return changes.select("verdict_id", "change", F.round(text.edit_ratio(F.col("before"), F.col("after")), 6).alias("ratio"))


@query("""
    WITH o AS (SELECT video_id, day, lifetime.impressions AS impressions FROM (SELECT *, row_number() OVER (PARTITION BY video_id, day ORDER BY loaded_at DESC, row_id DESC) AS rn FROM lifetime_daily) WHERE rn = 1)
    SELECT video_id, day, impressions, impressions - lag(impressions) OVER (PARTITION BY video_id ORDER BY day) AS delta FROM o""")
def daily_deltas(spark, d):
    """W4."""
    return titles.daily_deltas(table(spark, d, "lifetime_daily"))


@query("""
    WITH m AS (SELECT date_trunc('month', day) AS month, sum(coalesce(lifetime.impressions, 0)) AS s FROM lifetime_daily GROUP BY 1),
    b AS (SELECT *, min(s) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM m),
    g AS (SELECT *, sum(CASE WHEN low IS NULL OR s < low THEN 1 ELSE 0 END) OVER (ORDER BY month) AS g FROM b),
    r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY month) - 1 AS stale FROM g)
    SELECT CAST(month AS DATE) AS month, CAST(s AS BIGINT) AS loss, CAST(stale AS INTEGER) AS stale, stale >= 2 AS stop FROM r""")
def early_stop(spark, d):
    """W8 over monthly sums, one sequence of a few months."""
    m = table(spark, d, "lifetime_daily").groupBy(F.trunc("day", "month").alias("month")).agg(F.sum(F.coalesce("lifetime.impressions", F.lit(0))).alias("loss"))
    return gates.early_stop(m.withColumn("all", F.lit(1)), ["all"], "month", "loss", 2).select("month", "loss", F.col("stale").cast("int").alias("stale"), "stop")


@query("""
    WITH c AS (SELECT channel, count(*) AS videos FROM videos WHERE channel IS NOT NULL GROUP BY channel),
    b AS (SELECT channel, count(*) AS pages FROM descriptions WHERE channel IS NOT NULL GROUP BY channel)
    SELECT coalesce(b.channel, c.channel) AS channel, coalesce(c.videos, b.pages) AS size FROM b FULL JOIN c ON b.channel = c.channel""")
def registry_upsert(spark, d):
    """K8: a registry of channels by pages, with the counts of videos put over it."""
    base = table(spark, d, "descriptions").where("channel is not null").groupBy("channel").agg(F.count("*").alias("size"))
    new = table(spark, d, "videos").where("channel is not null").groupBy("channel").agg(F.count("*").alias("size"))
    return joins.upsert(base, new, "channel")


@query("""
    WITH k AS (SELECT DISTINCT video_id AS k FROM videos WHERE video_id IS NOT NULL), v AS (SELECT DISTINCT video_id AS k FROM verdicts WHERE video_id IS NOT NULL),
    p AS (SELECT DISTINCT video_id AS k FROM descriptions WHERE video_id IS NOT NULL), a AS (SELECT k FROM k UNION SELECT k FROM v UNION SELECT k FROM p),
    m AS (SELECT a.k AS video_id, array_to_string(list_filter([CASE WHEN k.k IS NULL THEN 'files' END, CASE WHEN v.k IS NULL THEN 'metadata' END, CASE WHEN p.k IS NULL THEN 'ingested' END], lambda x: x IS NOT NULL), ',') AS missing_from
          FROM a LEFT JOIN k ON a.k = k.k LEFT JOIN v ON a.k = v.k LEFT JOIN p ON a.k = p.k)
    SELECT video_id, missing_from FROM m WHERE missing_from <> ''""")
def orphans(spark, d):
    """Videos as files, verdicts as metadata, pages as what was ingested."""
    return joins.orphans(table(spark, d, "videos"), table(spark, d, "verdicts"), table(spark, d, "descriptions"), "video_id")


@query("SELECT v.video_id FROM videos v WHERE NOT EXISTS (SELECT 1 FROM descriptions d WHERE d.video_id = v.video_id)")
def fetch_todo(spark, d):
    """What is left to fetch."""
    return joins.todo(table(spark, d, "videos").select("video_id"), table(spark, d, "descriptions"), "video_id")


@query("SELECT row_id, video_id FROM lifetime_daily WHERE video_id IN (SELECT video_id FROM descriptions)")
def restrict_list(spark, d):
    """J3."""
    return joins.restrict(table(spark, d, "lifetime_daily").select("row_id", "video_id"), table(spark, d, "descriptions"), "video_id")


@query("""
    WITH m AS (SELECT channel, lifetime.ctr AS x FROM lifetime_daily WHERE lifetime.ctr IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY channel) AS n FROM m)
    SELECT channel, count(*) AS n, max(x) FILTER (WHERE i = n // 2) AS upper_median, round(quantile_cont(CAST(x AS DOUBLE), 0.5), 9) AS median,
           max(x) FILTER (WHERE i = CAST(round_even(0.95 * (n - 1), 0) AS BIGINT)) AS p95_nearest, round(quantile_cont(CAST(x AS DOUBLE), 0.9) - quantile_cont(CAST(x AS DOUBLE), 0.1), 9) AS spread
    FROM r GROUP BY channel""")
def dist_summary(spark, d):
    """A1-A3: the medians and percentiles side by side."""
    m = table(spark, d, "lifetime_daily").select("channel", F.col("lifetime.ctr").alias("x")).where("x is not null")
    points = {"median": 0.5, "p90": 0.9, "p10": 0.1}
    ranks = stats.order_statistics(m, ["channel"], "x", {"upper_median": stats.upper_index, "p95_nearest": stats.nearest_index(0.95)}, points)
    ranks = ranks.select("channel", "upper_median", F.round("median", 9).alias("median"), "p95_nearest", F.round(F.col("p90") - F.col("p10"), 9).alias("spread"))
    return m.groupBy("channel").agg(F.count("*").alias("n")).alias("b").join(ranks.alias("r"), F.col("b.channel").eqNullSafe(F.col("r.channel"))).select("r.channel", "n", "upper_median", "median", "p95_nearest", "spread")
