"""Quality gates: a verdict per row by the first rule that holds, and one row that says whether all pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.stats import order_statistics, upper_index
from corpusloom.functions.text import let, word_ngrams

# What the gates are calibrated to.
LOOP_NGRAM, COVERAGE_FLOOR, BLOAT_CEILING = 6, 0.85, 1.5
FAIL_OFFSET, WARN_OFFSET, FAIL_DRIFT, NEAR_SHARE = 1.5, 0.75, 3.0, 0.40
TOKENS_PER_SECOND, SEQUENCE, TEXT_RESERVE = 82.5, 2048, 256


def has_repeat(words: Column, n: int = LOOP_NGRAM) -> Column:
    """Some run of ``n`` words stands twice."""
    return let(word_ngrams(words, n), lambda grams: F.size(F.array_distinct(grams)) < F.size(grams))


def repeated_ngrams(df: DataFrame, key: str, words: Column, n: int = LOOP_NGRAM) -> DataFrame:
    """Key, gram, n of the runs of ``n`` words that stand more than once in one text."""
    return df.select(F.col(key), F.explode(word_ngrams(words, n)).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("n")).where("n > 1")


def loop_gate(df: DataFrame, failed: Column, said: Column, coverage: Column, seconds: Column, text: Column) -> DataFrame:
    """G1: ``df`` with bloat and verdict, first match of FAIL, LOOP, DROP, BLOAT, ok. Bloat is seconds per character over
    the upper median of the rendered rows with text (a one-row aggregate, broadcast)."""
    per = seconds / F.length(text)
    use = ~failed & (F.length(text) > 0)
    values = df.select(F.when(use, per).alias("_per"))
    ref = order_statistics(values, [], "_per", {"_ref": upper_index})
    ref = values.sparkSession.range(1).select(F.lit(None).cast("double").alias("_none")).join(ref, F.lit(True), "left").drop("_none")  # one row, also for no values
    bloat = F.coalesce(F.when(F.length(text) > 0, per / F.nullif("_ref", F.lit(0.0))), F.lit(1.0))
    verdict = F.when(failed, "FAIL").when(has_repeat(said), "LOOP").when(coverage < COVERAGE_FLOOR, "DROP").when(bloat > BLOAT_CEILING, "BLOAT").otherwise("ok")
    return df.crossJoin(F.broadcast(ref)).withColumn("bloat", bloat).withColumn("verdict", verdict).drop("_ref")


def verdict_counts(df: DataFrame, verdict: str = "verdict", good: str = "ok") -> DataFrame:
    """One row: rows, good, passed (every row is good; an empty table passes)."""
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(verdict) == good).alias("good")).withColumn("passed", F.col("rows") == F.col("good"))


def expected_tokens(chars: Column) -> Column:
    """tokens a text should take: max(300, chars / 18.4 * 84)."""
    return F.greatest(F.lit(300.0), chars / 18.4 * 84)


def greedy_expected(chars: Column) -> Column:
    """F13, greedy variant: max(300, int(chars / 18 * 86 * 1.6))."""
    return F.greatest(F.lit(300), F.floor(chars / 18 * 86 * 1.6).cast("int"))


def eos_verdict(stopped: Column, tokens: Column, chars: Column) -> Column:
    """Pass iff it stopped and is no runaway: tokens below min(3700, twice the expected)."""
    runaway = tokens >= F.least(F.lit(3700), 2 * greedy_expected(chars))
    return stopped & ~runaway


def eos_ramp(n: Column, start: Column, expected: Column, boost: float) -> Column:
    """what is added to the stop token's score at step ``n``; 0 before ``start``."""
    return F.when(n < start, 0.0).otherwise(boost * F.least(F.lit(4.0), 1 + (n - start) / expected))


def within_token_budget(seconds: Column) -> Column:
    """F15."""
    return seconds * TOKENS_PER_SECOND <= SEQUENCE - TEXT_RESERVE


def epoch_distance(epochs: DataFrame, reference: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``epochs`` with distance, the sum of |metric - reference| / weight against the one row of ``reference``."""
    ref = reference.select(*(F.col(k).alias(f"_{k}") for k in weights))
    total = sum((F.abs(F.col(k) - F.col(f"_{k}")) / w for k, w in weights.items()), F.lit(0.0))
    return epochs.crossJoin(F.broadcast(ref)).withColumn("distance", total).drop(*(f"_{k}" for k in weights))


def unsafe_epoch(no_stop: Column, cap_hits: Column, max_silence: Column, overrun_p90: Column) -> Column:
    return (no_stop > 0) | (cap_hits > 0) | (max_silence >= 3.0) | (overrun_p90 >= 1.6)


def best_epoch(epochs: DataFrame, name: str, unsafe: Column) -> DataFrame:
    """The safe epoch of least distance; ties by name; no row without one."""
    return epochs.where(~unsafe).agg(F.min_by(name, F.struct("distance", name)).alias(name), F.min("distance").alias("distance")).where(F.col(name).isNotNull())


def verify_failures(maxoff: Column, drift_max: Column, corrected: Column, threshold: Column, checked: Column, near: Column) -> Column:
    """The reasons a verification fails, an empty list if none does."""
    return F.array_compact(
        F.array(
            F.when(maxoff > FAIL_OFFSET, "offset"), F.when((drift_max > FAIL_DRIFT) & (corrected == 0), "drift, nothing corrected"), F.when(threshold > FAIL_DRIFT, "correction threshold too loose"),
            F.when((checked > 0) & (near < NEAR_SHARE), "boundaries away from silence"),
        )
    )


def verify_warnings(maxoff: Column, p95: Column) -> Column:
    return F.array_compact(F.array(F.when(maxoff > WARN_OFFSET, "offset"), F.when(p95 > WARN_OFFSET, "drift p95")))


def ring_bins(df: DataFrame, chunk: str, hz: str, width: float = 250.0, share: float = 1 / 3) -> DataFrame:
    """Frequency bins that ring in more than ``share`` of all chunks: bin, chunks."""
    total = df.agg(F.count_distinct(chunk).alias("_all"))
    bins = df.select(chunk, (F.floor(F.col(hz) / width) * width).alias("bin")).where("bin is not null").distinct().groupBy("bin").agg(F.count("*").alias("chunks"))
    return bins.crossJoin(F.broadcast(total)).where(F.col("chunks") > F.col("_all") * share).drop("_all")


def tail_loop(ids: Column, last: int = 70) -> Column:
    """Of the last ``last`` items: unique, and the longest run of one item."""
    tail = F.slice(ids, F.greatest(F.lit(1), F.size(ids) - last + 1), F.lit(last))
    start = F.struct(F.lit(None).cast("long").alias("x"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["x"].eqNullSafe(x.cast("long")), acc["run"] + 1).otherwise(1)
        return F.struct(x.cast("long").alias("x"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.struct(F.size(F.array_distinct(tail)).alias("unique"), F.aggregate(tail, start, step, lambda a: a["best"]).alias("longest"))


def early_stop(df: DataFrame, by: list[str], order: str, loss: str, patience: int) -> DataFrame:
    """``df`` with stale (evaluations since the least loss so far) and stop (stale >= patience)."""
    w = Window.partitionBy(*by).orderBy(order)
    before = F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, -1))
    better = F.when(before.isNull() | (F.col(loss) < before), 1).otherwise(0)
    rows = df.withColumn("_b", better).withColumn("_g", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    stale = F.row_number().over(Window.partitionBy(*by, "_g").orderBy(order)) - 1
    return rows.withColumn("stale", stale).withColumn("stop", F.col("stale") >= patience).drop("_b", "_g")


def failure_streaks(df: DataFrame, by: list[str], order: str, ok: Column) -> DataFrame:
    """``df`` with streak, the failures in a row up to this row; a success resets it."""
    w = Window.partitionBy(*by).orderBy(order)
    rows = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_g", F.sum(F.col("_ok").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.sum((~F.col("_ok")).cast("int")).over(Window.partitionBy(*by, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("streak", own).drop("_ok", "_g")


def corpus_audit(clips: DataFrame, rate: int, channels: int, shortest: float, longest: float) -> DataFrame:
    """V2: conditional counts over a corpus table: rows, bad_rate, bad_channels, missing (no audio), short, long, over_budget, speakers."""
    c = F.count_if
    s = F.col("seconds")
    return clips.agg(
        F.count("*").alias("n"), c(F.col("sample_rate") != rate).alias("bad_rate"), c(F.col("channels") != channels).alias("bad_channels"), c(s.isNull()).alias("missing"),
        c(s < shortest).alias("short"), c(s > longest).alias("long"), c(~within_token_budget(s)).alias("over_budget"), F.count_distinct("speaker").alias("speakers"),
    )


def text_lints(text: Column, rhymes: Column | None = None) -> Column:
    """Which lints a text trips: endnote mark, heading in capitals."""
    return F.array_compact(F.array(F.when(text.rlike(r"[.!?][ \t\n\r]+[0-9]{1,3}[ \t\n\r]+[A-Z]"), "endnote"), F.when(text.rlike(r"\b[A-Z]{4,} [A-Z]{4,}\b"), "capitals")))


# Fixed value: remarks about a transcript instead of its content.
META = (
    r"transcript (file )?(appears to be |is )?(missing|empty|corrupt|unavailable|unreadable)|insufficient content|unable to (read|access|generate|process)|"
    r"no (usable |coherent )?(content|transcript) (found|available)|cannot (be )?(read|access|summari[sz]e)|(file|transcript) (not found|does not exist)|i (was )?(could not|couldn't|cannot|can't)"
)


def junk_reason(body: Column, source_bytes: Column, least: int = 150, substantial: int = 3000) -> Column:
    """Why a summary is junk, null if it is not: a remark about the transcript first, then too short for its source."""
    return F.when(body.rlike("(?i)" + META), "meta-commentary").when((F.length(F.trim(body)) < least) & (source_bytes >= substantial), "too short")


def text_qc(df: DataFrame, sim: Column, compression: Column, logprob: Column, chars: Column, least: int = 60) -> DataFrame:
    """Rows of enough text with sim, compression, logprob and loop (compression over 2)."""
    return df.where(chars >= least).withColumn("sim", sim).withColumn("loop", compression > 2.0).withColumn("logprob", logprob)


def transcript_fidelity(df: DataFrame, error: Column, want: Column, got: Column, most: float = 0.10) -> DataFrame:
    """One row over clips with their word error rate and their words as written and as heard (arrays): clips, mean_wer,
    first_missing and last_missing (clips whose first or last word was not heard), passed (a mean below ``most`` and none
    missing; no clips do not pass). Clips without words are left out."""
    rows = df.select(error.alias("_e"), want.alias("_w"), got.alias("_g")).where(F.size("_w") > 0)
    heard = lambda at: F.array_contains(F.coalesce("_g", F.array().cast("array<string>")), F.element_at("_w", at))
    out = rows.agg(F.count("*").alias("clips"), F.avg("_e").alias("mean_wer"), F.count_if(~heard(1)).alias("first_missing"), F.count_if(~heard(-1)).alias("last_missing"))
    good = (F.col("mean_wer") < most) & (F.col("first_missing") == 0) & (F.col("last_missing") == 0)
    return out.withColumn("passed", F.coalesce(good, F.lit(False)))
