"""Queries of the training-data problems, and SQL for those SQL can express. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, lookalike, overlap, packing, pairs, quantiles, site_lines, splitting, truncation
from corpusloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defective_pairs(table(spark, d, "verdicts"), table(spark, d, "descriptions", spread=True))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Defects by channel of the description."""
    where = table(spark, d, "verdicts").select("verdict_id", "video_id").join(table(spark, d, "descriptions", spread=True).select("video_id", "channel"), "video_id")
    return p1_found(spark, d).join(where, "verdict_id").groupBy("channel", "defect").agg(F.count("*").alias("pairs"))


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_clips(table(spark, d, "clips", spread=True), table(spark, d, "profiles"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every oversized clip has a piece 0."""
    return p2_pieces(spark, d).where("piece = 0").select("clip_id")


def p3_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.lifetime_percentiles(table(spark, d, "lifetime_daily"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.found(table(spark, d, "clips", spread=True))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.report(table(spark, d, "clips", spread=True))


def _p5(spark: SparkSession, d: str) -> lookalike.Tables:
    return [("clips", table(spark, d, "clips", spread=True), "clip_id", "text"), ("anchored_words", table(spark, d, "anchored_words", spread=True), "word_id", "word")]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.found_rows(_p5(spark, d))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.normalize(_p5(spark, d))


def _p6(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    df = table(spark, d, "descriptions", spread=True)
    return (df, *site_lines.repeated_lines(df, "video_id", F.col("channel"), F.col("snippet.description")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d)[1]


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    df, _, confirmed = _p6(spark, d)
    return site_lines.without_repeated(df, "video_id", F.col("channel"), F.col("snippet.description"), confirmed)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_ids(table(spark, d, "documents", spread=True))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents", spread=True), table(spark, d, "profiles"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, d), table(spark, d, "profiles"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents", spread=True)).where("truncated").select("doc_id")


def p9_by_source(spark: SparkSession, d: str) -> DataFrame:
    return truncation.by_source(truncation.truncated(table(spark, d, "documents", spread=True)))


def queries() -> dict[str, Query]:
    own = (p1_found, p1_report, p2_found, p2_pieces, p3_percentiles, p4_found, p4_report, p5_found, p5_repaired, p6_found, p6_clean, p7_ids, p8_containers, p8_fill, p9_found, p9_by_source)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    lines = r"""
        WITH d AS (SELECT video_id, channel, string_split(snippet.description, chr(10)) AS ls FROM descriptions WHERE snippet.description IS NOT NULL),
        l AS (SELECT video_id, channel, unnest(ls) AS t, unnest(range(1, 1 + len(ls))) AS line_no FROM d),
        k AS (SELECT video_id, channel, line_no, replace(trim(lower(regexp_replace(t, '[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))), 'ß', 'ss') AS k FROM l),
        c AS (SELECT channel, count(*) AS n FROM d GROUP BY channel),
        h AS (SELECT k.channel, k.k FROM k JOIN c ON c.channel IS NOT DISTINCT FROM k.channel WHERE k.k <> '' GROUP BY k.channel, k.k, c.n
              HAVING count(DISTINCT video_id) >= 5 AND count(DISTINCT video_id) >= 0.05 * c.n)"""
    return {
        "p2_found": """SELECT c.clip_id FROM clips c JOIN profiles p ON c.profile = p.profile
            WHERE c.seconds > p.max_clip_seconds OR length(c.text) > p.max_chars""",
        "p3_percentiles": """
            WITH m AS (SELECT 'ctr' AS metric, channel, format, CAST(lifetime.ctr AS DOUBLE) AS v FROM lifetime_daily
                       UNION ALL SELECT 'impressions', channel, format, CAST(lifetime.impressions AS DOUBLE) FROM lifetime_daily),
            l AS (SELECT metric, 'channel_format' AS level, channel, format, v FROM m UNION ALL SELECT metric, 'channel', channel, NULL, v FROM m)
            SELECT metric, level, channel, format, count(v) AS n, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90,
                   round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99
            FROM l WHERE v IS NOT NULL GROUP BY metric, level, channel, format""",
        "p6_found": lines + " SELECT k.video_id, CAST(k.line_no AS INTEGER) AS line_no FROM k JOIN h ON k.k = h.k AND k.channel IS NOT DISTINCT FROM h.channel",
    }
