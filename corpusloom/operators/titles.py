"""From videos, verdicts and page texts to tiered chat examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.stats import percent_below_scaled
from corpusloom.functions.text import clean_title, without_boilerplate, without_title_echo
from corpusloom.operators.select import chronological_split
from corpusloom.session import materialize

# Who is rated, and the tiers by percent of the group strictly below.
LEAST_IMPRESSIONS, TOP, STRONG, TYPICAL, LEAST_CONTENT, EVAL_SHARE = 1000, 90, 70, 30, 60, 0.08


def latest(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per key: the greatest by ``newest`` (give a unique last column). An aggregate, not a window: it combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row"))
    return best.select(*keys, "_row.*")


def tiers(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` (with lifetime) and tier: unrated without a rate or enough impressions, else by the share of the
    group's rated rows strictly below."""
    rated = F.col("lifetime.ctr").isNotNull() & (F.coalesce("lifetime.impressions", F.lit(0)) >= LEAST_IMPRESSIONS)
    scored = percent_below_scaled(rows.withColumn("_ctr", F.when(rated, F.col("lifetime.ctr"))), "_ctr", group)
    p = F.col("pct_below")
    tier = F.when(p.isNull(), "unrated").when(p >= TOP, "top-decile").when(p >= STRONG, "strong").when(p >= TYPICAL, "typical").otherwise("weak")
    return scored.withColumn("tier", tier).drop("_ctr", "pct_below")


def title_rows(videos: DataFrame, verdicts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """The latest verdict of each video with its format, channel, tier, has_page and page (its text without
    boilerplate, taken out before the join so that less is shuffled; null without a text)."""
    v = latest(videos.select("video_id", "channel", "format", "published_at", "loaded_at"), ["video_id"], ["loaded_at"]).drop("loaded_at")
    d = latest(verdicts.select("video_id", "verdict_id", "titles", "lifetime", "loaded_at"), ["video_id"], ["loaded_at", "verdict_id"]).drop("loaded_at")
    pages = descriptions.select("video_id", F.col("snippet").isNotNull().alias("has_page"), without_boilerplate(F.col("snippet.description")).alias("page"))
    return tiers(d.join(v, "video_id"), ["channel", "format"]).join(pages, "video_id", "left")


def examples(videos: DataFrame, verdicts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Text examples: video_id, verdict_id, channel, format, tier, title, content, published_at, split. Videos without a
    snippet, a title or LEAST_CONTENT characters of content are left out (``backfill`` lists the last)."""
    rows = _cleaned(title_rows(videos, verdicts, descriptions)).where(F.length("content") >= LEAST_CONTENT)
    ready = materialize(rows.select("video_id", "verdict_id", "channel", "format", "tier", "title", "content", "published_at"))  # a global order reads its input twice
    return chronological_split(ready, ["published_at", "video_id"], EVAL_SHARE)


def backfill(videos: DataFrame, verdicts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Videos with a title whose page text says too little: video_id, channel, format, title, content_chars."""
    rows = _cleaned(title_rows(videos, verdicts, descriptions)).where(F.length("content") < LEAST_CONTENT)
    return rows.select("video_id", "channel", "format", "title", F.length("content").alias("content_chars"))


def _cleaned(rows: DataFrame) -> DataFrame:
    usable = rows.where(F.col("has_page") & (F.size("titles") > 0) & F.element_at("titles", -1).isNotNull())
    titled = usable.withColumn("title", clean_title(F.element_at("titles", -1)))
    return titled.withColumn("content", without_title_echo(F.coalesce("page", F.lit("")), F.col("title")))


def messages(df: DataFrame, system: str = "Write a title for the video.") -> DataFrame:
    """``df`` with messages: system, user (channel, format, target tier, content), assistant (the title)."""
    user = F.concat(F.lit("channel: "), F.coalesce("channel", F.lit("")), F.lit("\nformat: "), F.coalesce("format", F.lit("")), F.lit("\ntarget: "), F.col("tier"), F.lit("\n\nVideo:\n"), F.col("content"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return df.withColumn("messages", F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", F.col("title"))))


def title_changes(verdicts: DataFrame) -> DataFrame:
    """verdict_id, change (from 1), before, after for each step of a title's history."""
    steps = F.transform(F.sequence(F.lit(1), F.size("titles") - 1), lambda i: F.struct(i.alias("change"), F.get("titles", i - 1).alias("before"), F.get("titles", i).alias("after")))
    some = verdicts.where(F.size("titles") > 1)
    return some.select("verdict_id", F.explode(steps).alias("s")).select("verdict_id", "s.*")


def daily_deltas(daily: DataFrame) -> DataFrame:
    """Change of impressions between the days of a video; a day delivered twice counts once."""
    once = latest(daily.select("video_id", "day", "row_id", F.col("lifetime.impressions").alias("impressions"), "loaded_at"), ["video_id", "day"], ["loaded_at", "row_id"])
    w = Window.partitionBy("video_id").orderBy("day")
    return once.select("video_id", "day", "impressions", (F.col("impressions") - F.lag("impressions").over(w)).alias("delta"))
