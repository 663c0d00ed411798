"""Queries over clips, anchored_words, documents and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats, text, udfs
from corpusloom.operators import align, gates, glossary, intervals, joins, planner, reports, select, sft
from corpusloom.operators.titles import latest
from corpusloom.plans.registry import query
from corpusloom.session import table
from corpusloom.sources import vtt


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", spread=True).where(F.col("text").isNotNull())


def _clips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clips", spread=True)


def _words(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each (stem, pos)."""
    return latest(table(spark, d, "anchored_words"), ["stem", "pos"], ["word_id"])


_WORDS = "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem, pos ORDER BY word_id DESC) AS rn FROM anchored_words) WHERE rn = 1)"

# ---------------------------------------------------------------- splits, samples, selection


@query("""
    WITH c AS (SELECT clip_id, row_number() OVER (ORDER BY clip_id) - 1 AS i, count(*) OVER () AS n FROM clips),
    k AS (SELECT *, CAST(round_even(n * 0.15, 0) AS BIGINT) AS k FROM c),
    x AS (SELECT DISTINCT CAST(round_even(j * ((n - 1) / CAST(k - 1 AS DOUBLE)), 0) AS BIGINT) AS i FROM (SELECT DISTINCT n, k FROM k), LATERAL (SELECT unnest(range(0, k)) AS j)
          UNION SELECT DISTINCT n - 1 FROM k)
    SELECT clip_id, CASE WHEN i IN (SELECT i FROM x) THEN 'eval' ELSE 'train' END AS split FROM k""")
def even_spread_split(spark, d):
    """L7/T9."""
    return select.even_spread(_clips(spark, d).select("clip_id"), ["clip_id"], 0.15).select("clip_id", "split")


@query("""
    WITH c AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
    SELECT doc_id FROM c WHERE i % greatest(1, n // 100) = 0 AND i < greatest(1, n // 100) * 100""")
def stride_sample(spark, d):
    """L2."""
    return select.stride_sample(table(spark, d, "documents").select("doc_id"), ["doc_id"], 100)


@query("SELECT clip_id, CASE WHEN (row_number() OVER (ORDER BY clip_id) - 1) % 10 = 4 THEN 'eval' ELSE 'train' END AS split FROM clips")
def modulo_split(spark, d):
    """L10."""
    return select.modulo_split(_clips(spark, d).select("clip_id"), ["clip_id"]).select("clip_id", "split")


@query("""
    WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT source, doc_id, CAST(i - greatest(0, floor((n - 5) / 2.0)) AS INTEGER) AS turn FROM r WHERE i - greatest(0, floor((n - 5) / 2.0)) BETWEEN 0 AND 4""")
def round_robin_sample(spark, d):
    """L4: the middle five of each source, in turn."""
    return select.round_robin(table(spark, d, "documents").select("source", "doc_id"), "source", ["doc_id"], 5)


@query("""
    WITH c AS (SELECT clip_id, seconds, sum(CAST(round(seconds * 1000) AS BIGINT)) OVER (ORDER BY src_start DESC, clip_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM clips WHERE seconds IS NOT NULL AND src_start IS NOT NULL)
    SELECT clip_id FROM c WHERE coalesce(before, 0) < 7200000""")
def budget_selection(spark, d):
    """Two hours of clips, those late in their source first."""
    c = _clips(spark, d).where("seconds is not null and src_start is not null").select("clip_id", (-F.col("src_start")).alias("_late"), F.round(F.col("seconds") * 1000).cast("long").alias("ms"))
    return select.budget(c, ["_late", "clip_id"], "ms", 7_200_000).select("clip_id")


@query("""
    WITH e AS (SELECT quantile_cont(seconds, 0.995) AS hi, quantile_cont(src_start, 0.1) AS lo FROM clips)
    SELECT clip_id FROM clips, e WHERE seconds <= hi AND src_start > lo""")
def percentile_pool(spark, d):
    """What is left between the percentiles."""
    return select.percentile_pool(_clips(spark, d).select("clip_id", "seconds", "src_start"), "seconds", "src_start").select("clip_id")


@query("""
    WITH low AS (SELECT clip_id, sum(CAST(round(seconds * 1000) AS BIGINT)) OVER (ORDER BY clip_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM clips WHERE sample_rate < 24000 AND seconds IS NOT NULL)
    SELECT clip_id FROM clips WHERE seconds IS NOT NULL AND NOT coalesce(sample_rate < 24000, false) UNION ALL SELECT clip_id FROM low WHERE coalesce(before, 0) < 3600000""")
def capped_fill(spark, d):
    """An hour at most of clips of a low rate."""
    c = _clips(spark, d).where("seconds is not null").select("clip_id", "sample_rate", F.round(F.col("seconds") * 1000).cast("long").alias("ms"))
    return select.capped_fill(c, F.col("sample_rate") < 24000, ["clip_id"], "ms", 3_600_000).select("clip_id")


@query("""
    WITH e AS (SELECT quantile_cont(seconds, 0.9) AS s9, quantile_cont(seconds, 0.1) AS s1, quantile_cont(trailing_pause, 0.9) AS t9 FROM clips),
    m AS (SELECT coalesce(seconds > s9, false) AS long, coalesce(seconds < s1, false) AS short, coalesce(trailing_pause > t9, false) AS tail, coalesce(length(text) < 40, false) AS brief, text IS NULL AS no_text FROM clips, e)
    SELECT count(*) AS rows_in, count_if(long) AS long, count_if(short) AS short, count_if(tail) AS tail, count_if(brief) AS brief, count_if(no_text) AS no_text,
           count_if(long OR short OR tail OR brief OR no_text) AS rejected, count_if(NOT (long OR short OR tail OR brief OR no_text)) AS kept FROM m""")
def multi_gate_report(spark, d):
    """L12."""
    c = _clips(spark, d).select("seconds", "trailing_pause", "text")
    rows = select.with_percentiles(c, {"s9": ("seconds", 0.9), "s1": ("seconds", 0.1), "t9": ("trailing_pause", 0.9)})
    masks = {"long": F.col("seconds") > F.col("s9"), "short": F.col("seconds") < F.col("s1"), "tail": F.col("trailing_pause") > F.col("t9"), "brief": F.length("text") < 40, "no_text": F.col("text").isNull()}
    return select.gate_report(rows, masks)


@query()
def seeded_holdout(spark, d):
    """200 clips in hash order."""
    return select.shuffled_holdout(_clips(spark, d).select("clip_id"), "clip_id", 200).select("clip_id", "split")


@query()
def bucket_targets(spark, d):
    """A target length per clip, 3-10 s and 10-20 s in the ratio 2:3."""
    return select.bucket_targets(_clips(spark, d).select("clip_id"), "clip_id", [(2, 3, 10), (3, 10, 20)])


@query("SELECT clip_id, speaker, seconds FROM clips WHERE seconds IS NOT NULL ORDER BY seconds DESC, clip_id LIMIT 25")
def longest_clips(spark, d):
    """L1/L3: a report of 25 rows."""
    return select.top_k(_clips(spark, d).where("seconds is not null").select("clip_id", "speaker", "seconds"), [F.desc("seconds"), F.col("clip_id")], 25)


@query("""
    WITH b AS (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, sum(n_chars) OVER () AS total FROM documents WHERE n_chars IS NOT NULL)
    SELECT doc_id, CAST(least(6, floor(coalesce(before, 0) * 7 / total)) AS INTEGER) AS part FROM b""")
def part_partition(spark, d):
    """Seven parts of about equal size, over one global order."""
    return intervals.sized_parts(table(spark, d, "documents").where("n_chars is not null").select("doc_id", "n_chars"), [], ["doc_id"], "n_chars", 7).select("doc_id", "part")


# ---------------------------------------------------------------- statistics


@query("SELECT CAST(floor(seconds / 5) * 5 AS BIGINT) AS bin, count(*) AS n FROM clips WHERE seconds IS NOT NULL GROUP BY 1")
def hist_fixed(spark, d):
    """A6."""
    return stats.histogram(_clips(spark, d), F.col("seconds"), 5).select(F.col("bin").cast("long").alias("bin"), "n")


@query("""
    WITH e AS (SELECT min(src_start) AS lo, max(src_start) AS hi FROM clips)
    SELECT CAST(least(11, floor((src_start - lo) / ((hi - lo) / 12))) AS INTEGER) AS bin, count(*) AS n FROM clips, e WHERE src_start IS NOT NULL GROUP BY 1""")
def hist_equal(spark, d):
    """Twelve bins, the last one closed."""
    return stats.equal_bins(_clips(spark, d).select("src_start"), "src_start", 12)


@query("""
    WITH r AS (SELECT stem, clip_id, row_number() OVER (PARTITION BY stem ORDER BY src_start, clip_id) - 1 AS i, count(*) OVER (PARTITION BY stem) AS n FROM clips WHERE stem IS NOT NULL AND src_start IS NOT NULL)
    SELECT stem, clip_id, CAST((SELECT max(p) FROM (SELECT unnest(range(0, 10)) AS p) WHERE p * n // 10 <= i) AS INTEGER) AS part FROM r""")
def deciles(spark, d):
    """Tenths of each source in time; not ntile."""
    return stats.chrono_parts(_clips(spark, d).where("stem is not null and src_start is not null").select("stem", "clip_id", "src_start"), ["src_start", "clip_id"], 10, ["stem"]).select("stem", "clip_id", "part")


@query(r"""
    WITH t AS (SELECT lang, unnest(list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda x: x <> '')) AS w FROM documents WHERE text IS NOT NULL),
    c AS (SELECT lang, w, count(*) AS n FROM t GROUP BY lang, w), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS rn FROM c)
    SELECT lang, CAST(sum(n) AS BIGINT) AS total, count(*) AS keys, CAST(sum(n) FILTER (WHERE rn <= 3) AS BIGINT) AS top, round(CAST(sum(n) FILTER (WHERE rn <= 3) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6) AS share FROM r GROUP BY lang""")
def topk_share(spark, d):
    """A5: share of the three most frequent words of each language."""
    return stats.topk_share(_docs(spark, d).select("lang", F.explode(text.tokens(F.col("text"))).alias("w")), "w", ["lang"])


@query("""
    SELECT count(*) AS n, count(*) FILTER (WHERE sample_rate <> 24000) AS bad_rate, count(*) FILTER (WHERE channels <> 1) AS bad_channels, count(*) FILTER (WHERE seconds IS NULL) AS missing, count(*) FILTER (WHERE seconds < 1.5) AS short,
           count(*) FILTER (WHERE seconds > 20) AS long, count(*) FILTER (WHERE seconds * 82.5 > 1792) AS over_budget, count(DISTINCT speaker) AS speakers FROM clips""")
def corpus_audit(spark, d):
    """V2/F15."""
    return gates.corpus_audit(_clips(spark, d), 24_000, 1, 1.5, 20.0)


@query("""
    SELECT regexp_extract(audio_file, '^(.*)_', 1) AS source, count(*) AS clips, CAST(round(sum(coalesce(seconds, 0)) * 1000) AS BIGINT) AS ms FROM clips GROUP BY 1""")
def source_counts(spark, d):
    """A1/A2: clips and length per source, the name before its last underscore."""
    c = _clips(spark, d).groupBy(F.regexp_extract("audio_file", "^(.*)_", 1).alias("source"))
    return c.agg(F.count("*").alias("clips"), F.round(F.sum(F.coalesce("seconds", F.lit(0.0))) * 1000).cast("long").alias("ms"))


@query("""
    SELECT clip_id, sum(CAST(round(seconds * 1000) AS BIGINT)) OVER (PARTITION BY stem ORDER BY src_start, clip_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ms FROM clips WHERE stem IS NOT NULL AND seconds IS NOT NULL""")
def join_times(spark, d):
    """Where each clip begins when those of a source are played in order; null for the first."""
    c = _clips(spark, d).where("stem is not null and seconds is not null").select("clip_id", "stem", "src_start", F.round(F.col("seconds") * 1000).cast("long").alias("ms"))
    out = intervals.join_times(c, ["stem"], ["src_start", "clip_id"], "ms")
    return out.select("clip_id", F.nullif(F.col("begins").cast("long"), F.lit(0)).alias("ms"))


# ---------------------------------------------------------------- text

_EXPAND = r"""
    t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(0, len(string_split(text, ' ')))) AS i FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, i, w, regexp_extract(w, '^([^0-9A-Za-z]*)([0-9]+)([^0-9A-Za-z]*)$', 1) AS lead, regexp_extract(w, '^([^0-9A-Za-z]*)([0-9]+)([^0-9A-Za-z]*)$', 2) AS digits, regexp_extract(w, '^([^0-9A-Za-z]*)([0-9]+)([^0-9A-Za-z]*)$', 3) AS trail FROM t),
    n AS (SELECT *, CASE WHEN digits <> '' AND length(digits) <= 9 THEN CAST(digits AS BIGINT) END AS n FROM p),
    s AS (SELECT doc_id, i, w, lead, trail, CASE WHEN n BETWEEN 0 AND 9999 THEN concat_ws(' ',
            CASE WHEN n >= 1000 THEN {ones}[n // 1000 + 1] || ' thousand' END, CASE WHEN n % 1000 >= 100 THEN {ones}[n % 1000 // 100 + 1] || ' hundred' END,
            CASE WHEN n % 100 >= 20 THEN {tens}[n % 100 // 10 - 1] END,
            CASE WHEN n % 100 < 20 THEN CASE WHEN n % 100 > 0 OR n = 0 THEN {ones}[n % 100 + 1] END WHEN n % 10 > 0 THEN {ones}[n % 10 + 1] END) END AS words FROM n),
    e AS (SELECT doc_id, string_agg(CASE WHEN words IS NULL THEN w ELSE lead || words || trail END, ' ' ORDER BY i) AS text FROM s GROUP BY doc_id)""".replace("{ones}", str(text.ONES)).replace("{tens}", str(text.TENS))


@query("WITH " + _EXPAND + " SELECT doc_id, md5(text) AS expanded FROM e")
def expand_digits(spark, d):
    """digits as words; the texts as their md5."""
    return _docs(spark, d).select("doc_id", F.md5(text.expand_digits(F.col("text"))).alias("expanded"))


@query("WITH " + _EXPAND + r" SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda x: regexp_matches(x, '[0-9]'))) AS INTEGER) AS leftovers FROM e")
def digit_leftovers(spark, d):
    return _docs(spark, d).select("doc_id", F.size(text.digit_leftovers(F.col("text"))).alias("leftovers"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[.!?][ \t\n\r]+[0-9]{1,3}[ \t\n\r]+[A-Z]')) AS INTEGER) AS marks, regexp_matches(text, '[0-9]') AS digits FROM documents WHERE text IS NOT NULL")
def endnote_lint(spark, d):
    """P10/P11."""
    return _docs(spark, d).select("doc_id", text.endnote_marks(F.col("text")).alias("marks"), text.has_digit(F.col("text")).alias("digits"))


_NUMBERS = ", ".join(f"'{w}'" for w in text.NUMBER_WORDS)


@query(rf"""
    SELECT doc_id, md5(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS n3,
      md5(array_to_string(list_filter(string_split_regex(regexp_replace(replace(lower(text), '-', ' '), '[^a-z0-9 \t\n\r'']', ' ', 'g'), '[ \t\n\r]+'), lambda x: x <> ''), ' ')) AS n4,
      md5(array_to_string(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), ' +'), lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ({_NUMBERS})), ' ')) AS n5,
      md5(trim(regexp_replace(regexp_replace(lower(text), '\[(?:break|pause)(?::[^\]]*)?\]', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))) AS n6
    FROM documents WHERE text IS NOT NULL""")
def normalizers(spark, d):
    """N3-N6, as md5 of each."""
    t = F.col("text")
    joined = lambda a: F.md5(F.array_join(a, " "))
    return _docs(spark, d).select("doc_id", F.md5(text.bare_word(t)).alias("n3"), joined(text.cue_tokens(t)).alias("n4"), joined(text.coverage_tokens(t)).alias("n5"), F.md5(text.speech_text(t)).alias("n6"))


@query("WITH " + _WORDS + """
    SELECT stem, pos, sum(coalesce(length(word) - length(translate(word, '"“”', '')), 0)) OVER (PARTITION BY stem ORDER BY pos ROWS UNBOUNDED PRECEDING) % 2 = 1 AS open_after FROM w""")  # fmt: skip
def quote_parity(spark, d):
    """Is a quotation open after each word of a source."""
    return intervals.quote_open_after(_words(spark, d), ["stem"], ["pos"], text.quote_marks(F.col("word"))).select("stem", "pos", "open_after")


@query(rf"""
    WITH n AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), ' +'), lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ({_NUMBERS})) AS w FROM documents WHERE text IS NOT NULL),
    g AS (SELECT doc_id, w, unnest(range(1, len(w) - 4)) AS i FROM n WHERE len(w) >= 6), k AS (SELECT doc_id, array_to_string(w[i:i + 5], ' ') AS gram FROM g)
    SELECT doc_id, gram, count(*) AS n FROM k GROUP BY doc_id, gram HAVING count(*) > 1""")
def ngram_loops(spark, d):
    """Runs of six words that stand twice in a text."""
    return gates.repeated_ngrams(_docs(spark, d), "doc_id", text.coverage_tokens(F.col("text")))


@query(rf"""
    WITH n AS (SELECT clip_id, text, seconds, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), ' +'), lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ({_NUMBERS})) AS w FROM clips),
    s AS (SELECT seconds / length(text) AS p, row_number() OVER (ORDER BY seconds / length(text)) - 1 AS i, count(*) OVER () AS c FROM clips WHERE seconds IS NOT NULL AND length(text) > 0),
    r AS (SELECT p AS ref FROM s WHERE i = c // 2),
    g AS (SELECT n.*, coalesce(len(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1)), lambda j: array_to_string(w[j:j + 5], ' ')))) < greatest(len(w) - 5, 0), false) AS loop FROM n)
    SELECT clip_id, CASE WHEN seconds IS NULL OR text IS NULL THEN 'FAIL' WHEN loop THEN 'LOOP' WHEN coalesce(CASE WHEN length(text) > 0 THEN seconds / length(text) / ref END, 1.0) > 1.5 THEN 'BLOAT' ELSE 'ok' END AS verdict FROM g, r""")
def gate_loop(spark, d):
    """G1 on the clips' own texts (what is heard is what is written, so nothing is dropped)."""
    c = _clips(spark, d).select("clip_id", "text", "seconds")
    failed = F.col("seconds").isNull() | F.col("text").isNull()
    return gates.loop_gate(c, failed, text.coverage_tokens(F.col("text")), F.lit(1.0), F.col("seconds"), F.col("text")).select("clip_id", "verdict")


@query(r"""
    SELECT clip_id, CASE WHEN regexp_matches(regexp_replace(rtrim(text), '["”’'']$', ''), '[,;:—-]$') THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END AS tail,
           round(greatest(300.0, length(text) / 18.4 * 84), 4) AS expected, seconds * 82.5 <= 1792 AS in_budget FROM clips WHERE text IS NOT NULL""")
def clip_expectations(spark, d):
    """F7, F13, F15."""
    c = _clips(spark, d).where("text is not null")
    return c.select("clip_id", text.tail_seconds(F.col("text")).alias("tail"), F.round(gates.expected_tokens(F.length("text")), 4).alias("expected"), gates.within_token_budget(F.col("seconds")).alias("in_budget"))


@query(r"""
    SELECT doc_id, greatest(0, len(regexp_extract_all(text, '[.!?]')) - 1) AS allowed, len(regexp_extract_all(text, '\n')) AS pauses,
           len(regexp_extract_all(text, '\n')) > greatest(0, len(regexp_extract_all(text, '[.!?]')) - 1) AS excess FROM documents WHERE text IS NOT NULL""")
def pause_budget(spark, d):
    """Line breaks against sentence ends."""
    t = F.col("text")
    allowed, pauses = F.greatest(F.lit(0), F.regexp_count(t, F.lit("[.!?]")) - 1).cast("long"), F.regexp_count(t, F.lit("\n")).cast("long")
    return _docs(spark, d).select("doc_id", allowed.alias("allowed"), pauses.alias("pauses"), (pauses > allowed).alias("excess"))


@query(r"""
    WITH t AS (SELECT doc_id, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')), '([.!?]) +', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, list_reduce(list_transform(s, lambda x: [x]), lambda acc, x: CASE WHEN length(acc[len(acc)]) + 1 + length(x[1]) <= 350
            THEN list_concat(acc[1:len(acc) - 1], [acc[len(acc)] || ' ' || x[1]]) ELSE list_concat(acc, x) END) AS p FROM t WHERE len(s) > 0)
    SELECT doc_id, CAST(unnest(range(0, len(p))) AS INTEGER) AS piece, unnest(p) AS text FROM p""")
def sentence_pack(spark, d):
    """Every document's sentences packed to pieces of at most 350 characters."""
    pieces = text.pack_sentences(text.sentences(F.col("text")), 350)
    return _docs(spark, d).select("doc_id", F.posexplode(pieces).alias("piece", "text"))


@query("SELECT doc_id, substring(md5(text), 1, 16) AS md5_16 FROM documents WHERE text IS NOT NULL")
def content_prefix(spark, d):
    """F17."""
    return _docs(spark, d).select("doc_id", F.substring(F.md5("text"), 1, 16).alias("md5_16"))


@query()
def html_text(spark, d):
    """Documents as HTML; plain ones come out with their entities decoded."""
    return _docs(spark, d).select("doc_id", F.length(udfs.html_text("text")).alias("chars"), F.size(udfs.html_headings("text")).alias("headings"))


@query()
def spoken_forms(spark, d):
    """scripture references and regnal numerals in their spoken form."""
    fixed = udfs.regnal(udfs.scripture("text"))
    return _docs(spark, d).select("doc_id", fixed.alias("r")).select("doc_id", F.md5("r.text").alias("text"), "r.changed")


_COMMON = ", ".join(f"'{w}'" for w in glossary.COMMON)
_GLOSSARY = rf"""
    en AS (SELECT replace(text, '’', chr(39)) AS t FROM documents WHERE text IS NOT NULL AND starts_with(lower(lang), 'en')),
    w AS (SELECT regexp_replace(regexp_replace(regexp_replace(raw, '^[^A-Za-z]+|[^A-Za-z\x27\-]+$', '', 'g'), '\x27s$', ''), '\x27+$', '') AS name FROM (SELECT unnest(string_split_regex(t, '[ \t\n\r]+')) AS raw FROM en)),
    n AS (SELECT name, count(*) AS n FROM w WHERE length(name) >= 3 AND regexp_matches(name, '^[A-Z]') AND name NOT IN ({_COMMON}) AND NOT contains(lower(name), 'n' || chr(39) || 't') AND lower(name) NOT IN ('i''m', 'i''ll', 'i''d', 'i''ve') GROUP BY name HAVING count(*) >= 2),
    i AS (SELECT DISTINCT regexp_extract(s, '[A-Za-z][A-Za-z\x27\-]+') AS name FROM (SELECT unnest(string_split_regex(t, '[.!?]+')) AS s FROM en)),
    o AS (SELECT lower(x) AS x FROM (SELECT unnest(regexp_extract_all(t, '[A-Za-z][A-Za-z\x27]+')) AS x FROM en) WHERE regexp_matches(x, '^[a-z]') GROUP BY 1 HAVING count(*) >= 5),
    g AS (SELECT n.name, n FROM n LEFT JOIN i ON i.name = n.name WHERE (i.name IS NULL OR n >= 4 OR regexp_matches(n.name, '[\x27-]')) AND lower(n.name) NOT IN (SELECT x FROM o))"""


@query("WITH " + _GLOSSARY + " SELECT name, n FROM g")
def glossary_names(spark, d):
    """A9 over the English documents."""
    return glossary.glossary(_docs(spark, d).where(F.lower("lang").startswith("en")), "text")


@query("WITH " + _GLOSSARY + r""",
    k AS (SELECT list_transform(regexp_extract_all(t, '[A-Za-z][A-Za-z\x27\-]+'), lambda x: regexp_replace(regexp_replace(x, '\x27s$', ''), '\x27+$', '')) AS ks FROM en),
    p AS (SELECT unnest(ks[:-2]) AS a, unnest(ks[2:]) AS b FROM k WHERE len(ks) > 1)
    SELECT a || ' ' || b AS name, count(*) AS n FROM p WHERE regexp_matches(a, '^[A-Z]') AND regexp_matches(b, '^[A-Z]') AND a NOT IN ({_COMMON}) AND b NOT IN ({_COMMON})
        AND lower(a) NOT IN (SELECT x FROM o) AND lower(b) NOT IN (SELECT x FROM o) GROUP BY a, b HAVING count(*) >= 2""".replace("{_COMMON}", _COMMON))  # fmt: skip
def glossary_pairs(spark, d):
    """Names of two words in the English documents."""
    return glossary.glossary_pairs(_docs(spark, d).where(F.lower("lang").startswith("en")), "text")


@query()
def fuzzy_names(spark, d):
    """Heard words near a name of the glossary."""
    names = glossary.glossary(_docs(spark, d).where(F.lower("lang").startswith("en")), "text")
    tokens = table(spark, d, "anchored_words").where("source = 'whisper'").select(glossary.core(F.col("word")).alias("token"))
    return joins.fuzzy_names(tokens, names).select("token", "name", F.round("ratio", 6).alias("ratio"))


# ---------------------------------------------------------------- timed text, aligned words


@query(r"""
    WITH b AS (SELECT doc_id, unnest(list_filter(string_split_regex(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n[ \t]*\n'), lambda x: regexp_matches(x, '([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}) --> ([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})'))) AS b FROM documents WHERE kind = 'vtt' AND text IS NOT NULL),
    c AS (SELECT doc_id, regexp_extract(b, '([0-9]{2}):([0-9]{2}):([0-9]{2}\.[0-9]{3}) --> ', ['h', 'm', 's']) AS f, regexp_extract(b, ' --> ([0-9]{2}):([0-9]{2}):([0-9]{2}\.[0-9]{3})', ['h', 'm', 's']) AS t,
            trim(regexp_replace(regexp_replace(b, '(?s)^.*?([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}) --> ([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})[^\n]*(?:\n|$)', ''), '[ \t\n\r\f\v]+', ' ', 'g')) AS text FROM b)
    SELECT doc_id, count(*) AS cues, CAST(sum(CAST(round(((CAST(t.h AS INT) * 60 + CAST(t.m AS INT)) * 60 + CAST(t.s AS DOUBLE) - (CAST(f.h AS INT) * 60 + CAST(f.m AS INT)) * 60 - CAST(f.s AS DOUBLE)) * 1000) AS BIGINT)) AS BIGINT) AS ms,
           CAST(sum(length(text)) AS BIGINT) AS chars FROM c WHERE text <> '' GROUP BY doc_id""")
def vtt_cues(spark, d):
    """Cues, their length and text of each timed document."""
    docs = _docs(spark, d).where("kind = 'vtt'")
    c = vtt.exploded(docs, "doc_id", vtt.block_cues(F.col("text")))
    return c.groupBy("doc_id").agg(F.count("*").alias("cues"), F.sum(F.round((F.col("end_s") - F.col("start_s")) * 1000).cast("long")).alias("ms"), F.sum(F.length("text")).alias("chars"))


_CAPTIONS_WHOLE = r"""
    WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), lambda x: trim(replace(x, chr(9), ' '))),
            lambda x: x <> '' AND x <> 'WEBVTT' AND NOT regexp_matches(x, '^[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3} --> ') AND NOT regexp_matches(x, '^(Kind:|Language:|NOTE|align:)')) AS ls FROM documents WHERE kind IN ('vtt', 'captions') AND text IS NOT NULL),
    t AS (SELECT doc_id, list_filter(list_transform(ls, lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'))), lambda x: x <> '') AS ls FROM l),
    r AS (SELECT doc_id, CASE WHEN len(ls) > 0 THEN list_reduce(list_transform(ls, lambda x: [x]), lambda acc, x: CASE WHEN suffix(acc[len(acc)], x[1]) THEN acc ELSE list_concat(acc, x) END) ELSE CAST([] AS VARCHAR[]) END AS k FROM t)
    SELECT doc_id, array_to_string(k, ' ') AS text FROM r"""
_CAPTIONS = _CAPTIONS_WHOLE.replace("array_to_string(k, ' ') AS text FROM r", "substring(array_to_string(k, ' '), 1, 30000) AS text FROM r")


@query(_CAPTIONS_WHOLE)
def caption_text(spark, d):
    """Timed and rolling captions as running text, whole."""
    docs = _docs(spark, d).where("kind in ('vtt', 'captions')")
    return docs.select("doc_id", vtt.caption_text(F.col("text"), most=None).alias("text"))


@query(_CAPTIONS)
def caption_text_30k(spark, d):
    """S4 with the cut at 30,000 characters that the title prompts are made with."""
    docs = _docs(spark, d).where("kind in ('vtt', 'captions')")
    return docs.select("doc_id", vtt.caption_text(F.col("text"), most=30_000).alias("text"))


@query("WITH " + _WORDS + """,
    m AS (SELECT stem, pos, start_s, row_number() OVER (PARTITION BY stem ORDER BY pos) AS i FROM w),
    k AS (SELECT *, max(CASE WHEN start_s IS NOT NULL THEN i END) OVER (PARTITION BY stem ORDER BY pos ROWS UNBOUNDED PRECEDING) AS a,
                 min(CASE WHEN start_s IS NOT NULL THEN i END) OVER (PARTITION BY stem ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS z FROM m)
    SELECT k.stem, k.pos, round(coalesce(k.start_s, x.start_s + (y.start_s - x.start_s) * ((k.i - k.a) / CAST(k.z - k.a AS DOUBLE))), 6) AS start_s
    FROM k LEFT JOIN m x ON x.stem = k.stem AND x.i = k.a LEFT JOIN m y ON y.stem = k.stem AND y.i = k.z""")  # fmt: skip
def fill_times(spark, d):
    """Missing start times between their known neighbours."""
    return align.fill_times(_words(spark, d).select("stem", "pos", "start_s"), ["stem"], "pos", "start_s").select("stem", "pos", F.round("start_s", 6).alias("start_s"))


@query("WITH " + _WORDS + """,
    r AS (SELECT stem, pos, word, start_s, end_s, source = 'whisper' AS hit, row_number() OVER (PARTITION BY stem ORDER BY pos) - 1 AS i FROM w),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY stem ORDER BY pos) AS island FROM r WHERE hit),
    s AS (SELECT stem, min(i) AS first_row, max(i) AS last_row, count(*) AS n FROM g GROUP BY stem, island)
    SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY first_row) - 1 AS run, first_row, last_row, n FROM s WHERE n >= 5""")  # fmt: skip
def heard_stretches(spark, d):
    """Q5: five or more words in a row that were only heard."""
    out = intervals.threshold_runs(_words(spark, d), ["stem"], ["pos"], F.col("source") == "whisper", 5)
    return out.select("stem", *(F.col(c).cast("long").alias(c) for c in ("run", "first_row", "last_row", "n")))


@query("WITH " + _WORDS + """,
    g AS (SELECT stem, pos, end_s AS g0, lead(start_s) OVER (PARTITION BY stem ORDER BY pos) AS g1, regexp_matches(rtrim(word), '[.?!"”)]$') AS closes FROM w)
    SELECT stem, pos, CAST(round((g1 - g0) * 1000) AS BIGINT) AS gap, CAST(round(CASE WHEN g1 - g0 >= 2.5 THEN 0.4 WHEN coalesce(closes, false) THEN least(g1 - g0, 2.0) ELSE least(g1 - g0, 0.3) END * 1000) AS BIGINT) AS kept FROM g WHERE g1 - g0 > 0.1""")  # fmt: skip
def capped_pauses(spark, d):
    """I16: pauses over 100 ms between words, and what is kept of each."""
    from pyspark.sql import Window

    w = _words(spark, d).withColumn("g1", F.lead("start_s").over(Window.partitionBy("stem").orderBy("pos"))).withColumnRenamed("end_s", "g0")
    gaps = w.where(F.col("g1") - F.col("g0") > 0.1)
    out = intervals.capped_pauses(gaps, F.coalesce(text.ends_sentence(F.col("word")), F.lit(False)))
    return out.select("stem", "pos", F.round((F.col("g1") - F.col("g0")) * 1000).cast("long").alias("gap"), F.round(F.col("kept") * 1000).cast("long").alias("kept"))


@query()
def greedy_clip_plan(spark, d):
    """Sentence ends of each source snapped to its pauses and merged to clips of about 10 s, at most 20 s."""
    from pyspark.sql import Window

    w = _words(spark, d).where("start_s is not null and end_s is not null and word is not null").withColumn("n", F.lead("start_s").over(Window.partitionBy("stem").orderBy("pos")))
    cues = intervals.quote_open_after(w, ["stem"], ["pos"], text.quote_marks(F.col("word"))).select(
        "stem", F.col("pos").alias("cue_idx"), F.col("end_s").alias("end"), text.ends_sentence(F.col("word")).alias("final"), F.lit(False).alias("heading"), "open_after"
    )
    gaps = w.where(F.col("n") - F.col("end_s") >= 0.05).select("stem", F.col("end_s").alias("g0"), F.col("n").alias("g1"))
    snapped = intervals.snap_boundaries(cues, gaps, "stem", 0.15).select("stem", F.col("pos").cast("double").alias("pos"), "struct", "quote_safe")
    first = w.groupBy("stem").agg(F.min("start_s").alias("pos")).select("stem", "pos", F.lit(False).alias("struct"), F.lit(True).alias("quote_safe"))
    return planner.planned(first.unionByName(snapped), "stem", 10.0, 20.0)


@query()
def aligned_sources(spark, d):
    """Q3: the words of each source that come from the book as its book, all of its words as what was heard."""
    w = _words(spark, d).where("word is not null")
    heard = w.where("start_s is not null and end_s is not null").select("stem", "pos", "word", F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    return align.aligned_sources(w.where("source = 'book'").select("stem", "pos", "word"), heard, "stem")


# ---------------------------------------------------------------- seeds between texts

_TOKENS = r"""list_filter(string_split_regex(regexp_replace(replace(lower(text), '-', ' '), '[^a-z0-9 \t\n\r'']', ' ', 'g'), '[ \t\n\r]+'), lambda x: x <> '')"""
_SEEDS = f"""
    b AS (SELECT clip_id AS k, {_TOKENS} AS w FROM clips WHERE text IS NOT NULL AND split = 'train'), h AS (SELECT clip_id AS k, {_TOKENS} AS w FROM clips WHERE text IS NOT NULL AND split <> 'train'),
    bg AS (SELECT k, i - 1 AS pos, array_to_string(w[i:i + 5], ' ') AS gram FROM (SELECT k, w, unnest(range(1, len(w) - 4)) AS i FROM b WHERE len(w) >= 6)),
    hg AS (SELECT k, i - 1 AS pos, array_to_string(w[i:i + 5], ' ') AS gram FROM (SELECT k, w, unnest(range(1, len(w) - 4)) AS i FROM h WHERE len(w) >= 6)),
    rare AS (SELECT gram FROM bg GROUP BY gram HAVING count(*) <= 6),
    s AS (SELECT bg.k AS book_key, hg.k AS heard_key, bg.pos AS book_pos, hg.pos AS heard_pos FROM hg JOIN bg USING (gram) WHERE gram IN (SELECT gram FROM rare))"""


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    c = _clips(spark, d).where("text is not null")
    w = text.cue_tokens(F.col("text")).alias("words")
    return joins.seeds(c.where("split = 'train'").select(F.col("clip_id").alias("book_key"), w), c.where("split <> 'train'").select(F.col("clip_id").alias("heard_key"), w))


@query("WITH " + _SEEDS + " SELECT book_key, heard_key, CAST(book_pos AS INTEGER) AS book_pos, CAST(heard_pos AS INTEGER) AS heard_pos FROM s")
def seed_anchor(spark, d):
    """Six-word runs of the training clips that stand at most six times, met in the other clips."""
    return _seeds(spark, d).select("book_key", "heard_key", "book_pos", "heard_pos")


@query(
    "WITH " + _SEEDS + """,
    i AS (SELECT *, heard_pos - row_number() OVER (PARTITION BY book_key, heard_key, book_pos - heard_pos ORDER BY heard_pos) AS island FROM s),
    r AS (SELECT book_key, heard_key, min(book_pos) AS book_pos, min(heard_pos) AS heard_pos, count(*) + 5 AS words FROM i GROUP BY book_key, heard_key, book_pos - heard_pos, island),
    k AS (SELECT *, row_number() OVER (PARTITION BY book_key, heard_key ORDER BY words DESC, heard_pos, book_pos) AS rn FROM r)
    SELECT book_key, heard_key, CAST(book_pos AS INTEGER) AS book_pos, CAST(heard_pos AS INTEGER) AS heard_pos, CAST(words AS INTEGER) AS words FROM k WHERE rn = 1"""
)
def seed_best_run(spark, d):
    """The longest exact run of each pair."""
    return joins.longest_runs(_seeds(spark, d))


def _seeded(spark: SparkSession, d: str, book: list[Column], heard: list[Column]) -> DataFrame:
    """Pairs that share a seed (book_key, heard_key), with ``book`` of the training clip and ``heard`` of the other one.

    Joined by sorting: Spark reckons a text made here at 20 bytes, and would broadcast all of them to the driver first."""
    c = _clips(spark, d).where("text is not null")
    b, h = c.where("split = 'train'").select(F.col("clip_id").alias("book_key"), *book), c.where("split <> 'train'").select(F.col("clip_id").alias("heard_key"), *heard)
    return _seeds(spark, d).select("book_key", "heard_key").distinct().join(b.hint("merge"), "book_key").join(h.hint("merge"), "heard_key")


@query()
def classify_route(spark, d):
    """Pairs that share a seed, the training clip as the book and the other as what was heard."""
    tokens = text.cue_tokens(F.col("text"))
    words, n = F.array_join(tokens, " "), F.size(tokens)
    rows = _seeded(spark, d, [words.alias("b"), n.alias("bn"), F.col("text").rlike('["“]').alias("dialogue")], [words.alias("h"), n.alias("hn")])
    rows = rows.withColumn("coverage", F.round(udfs.lcs_words("b", "h") / F.col("bn"), 6)).withColumn("ratio", F.round(F.col("hn") / F.col("bn"), 6))
    route = align.correction_route(F.col("dialogue"), F.col("coverage"), F.col("ratio"), F.lit(False), F.lit(-0.2), F.lit(0.1))
    return rows.select("book_key", "heard_key", "coverage", "ratio", route.alias("route"))


@query()
def text_similarity(spark, d):
    """Ratcliff-Obershelp similarity of pairs that share a seed."""
    t = text.speech_text(F.col("text"))
    rows = _seeded(spark, d, [t.alias("a")], [t.alias("b")])
    return rows.select("book_key", "heard_key", F.round(udfs.text_ratio(F.col("a"), F.col("b")), 6).alias("sim"))


# ---------------------------------------------------------------- chat records

_CHAT = """
    c AS (SELECT doc_id, CASE WHEN json_valid(text) THEN CAST(json_extract(text, '$.messages') AS JSON[]) END AS m FROM documents WHERE kind = 'chat' AND text IS NOT NULL),
    x AS (SELECT doc_id, m, list_transform(m, lambda j: json_extract_string(j, '$.role')) AS roles, list_transform(m, lambda j: json_extract_string(j, '$.content')) AS contents FROM c)"""


def _chats(spark: SparkSession, d: str) -> DataFrame:
    chat = _docs(spark, d).where("kind = 'chat'")
    return chat.select("doc_id", F.when(F.try_parse_json("text").isNotNull(), sft.chat_messages(F.col("text"))).alias("messages"))


@query("WITH " + _CHAT + """
    SELECT doc_id, CASE WHEN m IS NULL OR len(m) = 0 THEN 'no messages' WHEN len(list_filter(roles, lambda r: r IS NULL)) + len(list_filter(contents, lambda r: r IS NULL)) > 0 THEN 'not text'
                        WHEN roles[len(roles)] <> 'assistant' THEN 'last role' END AS problem FROM x""")  # fmt: skip
def chat_validate(spark, d):
    """What is wrong with each chat record, null for a good one."""
    return _chats(spark, d).select("doc_id", sft.chat_problem(F.col("messages")).alias("problem"))


@query("WITH " + _CHAT + r""",
    y AS (SELECT doc_id, unnest(roles) AS role, unnest(contents) AS content FROM x WHERE m IS NOT NULL),
    t AS (SELECT doc_id, role, len(list_filter(string_split_regex(content, '[ \t\n\r]+'), lambda w: w <> '')) AS n FROM y)
    SELECT doc_id, CAST(coalesce(sum(n) FILTER (WHERE role = 'assistant'), 0) AS INTEGER) AS supervised, CAST(sum(n) AS INTEGER) AS total FROM t GROUP BY doc_id""")  # fmt: skip
def label_mask_stats(spark, d):
    """Supervised and all tokens of each record, words as tokens and their hash as id."""
    ids = lambda m: F.transform(text.tokens(m["content"]), lambda w: F.abs(F.hash(w)))
    spans = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), ids(m).alias("ids")))
    supervised, total = sft.token_account(sft.masked_labels(spans))
    return _chats(spark, d).where("messages is not null").select("doc_id", supervised.alias("supervised"), total.alias("total"))


# ---------------------------------------------------------------- summaries


@query("""
    WITH c AS (SELECT clip_id, row_number() OVER (ORDER BY clip_id) AS i FROM clips) SELECT clip_id, 'clip_' || lpad(CAST(i AS VARCHAR), 6, '0') AS name FROM c""")
def numbered_clips(spark, d):
    """W10."""
    return reports.numbered_names(_clips(spark, d).select("clip_id"), ["clip_id"], "clip_").select("clip_id", "name")


@query("""
    SELECT speaker, count(seconds) AS n, round(quantile_cont(seconds, 0.5), 6) AS median, round(quantile_cont(seconds, 0.9), 6) AS p90, max(seconds) AS most, round(stddev_pop(seconds), 6) AS deviation FROM clips GROUP BY speaker""")
def speaker_summary(spark, d):
    """A11."""
    s = reports.model_summary(_clips(spark, d), ["speaker"], "seconds")
    return s.select("speaker", "n", *(F.round(c, 6).alias(c) for c in ("median", "p90")), "most", F.round("deviation", 6).alias("deviation"))


@query("""
    WITH r AS (SELECT CAST(floor(start_s / 600) * 600 AS BIGINT) AS from_s FROM anchored_words WHERE start_s IS NOT NULL) SELECT from_s, count(*) AS n FROM r GROUP BY from_s""")
def word_density(spark, d):
    """A10: words per ten minutes of source time."""
    return reports.density(table(spark, d, "anchored_words"), "start_s").select(F.col("from_s").cast("long").alias("from_s"), "n")


@query("""
    WITH r AS (SELECT CAST(floor(src_start / 250) * 250 AS BIGINT) AS bin, seconds, row_number() OVER (PARTITION BY floor(src_start / 250) ORDER BY seconds DESC NULLS LAST, src_start) AS rn FROM clips WHERE src_start IS NOT NULL)
    SELECT bin, count(*) AS n, max(seconds) AS strongest, len(list(seconds) FILTER (WHERE rn <= 4 AND seconds IS NOT NULL)) AS exemplars FROM r GROUP BY bin""")
def clip_clusters(spark, d):
    """A10: clips by place in their source, the four longest of each bin as exemplars."""
    c = reports.clusters(_clips(spark, d).select("src_start", "seconds"), "src_start", "seconds", 250)
    return c.select(F.col("bin").cast("long").alias("bin"), "n", "strongest", F.when(F.size("exemplars") > 0, F.size("exemplars").cast("long")).alias("exemplars"))


@query("""
    SELECT clip_id, CAST(round(greatest(0.0, trailing_pause - 0.3) * 1000) AS BIGINT) AS self_ms, coalesce(seconds BETWEEN 1.5 AND 20.5, false) AS length_ok FROM clips WHERE trailing_pause IS NOT NULL""")
def tails_and_lengths(spark, d):
    """A16, P3."""
    c = reports.self_tail(_clips(spark, d).where("trailing_pause is not null"), "trailing_pause", 0.3)
    return c.select("clip_id", F.round(F.col("self_tail") * 1000).cast("long").alias("self_ms"), F.coalesce(reports.length_ok(F.col("seconds"), 20.0, slack=0.5), F.lit(False)).alias("length_ok"))


@query(r"""
    WITH w AS (SELECT clip_id, list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda x: x <> '') AS w FROM clips WHERE text IS NOT NULL)
    SELECT clip_id, len(w) >= 10 AND len(list_filter(w[1:6], lambda x: regexp_matches(x, '[0-9]'))) = 0 AS friendly FROM w""")
def probe_friendly(spark, d):
    """P12."""
    return _clips(spark, d).where("text is not null").select("clip_id", reports.probe_friendly(F.col("text")).alias("friendly"))


@query("""
    SELECT * FROM (SELECT clip_id, length(text) AS chars, CASE WHEN length(text) BETWEEN 200 AND 360 THEN 0 ELSE 1 END AS band FROM clips WHERE length(text) BETWEEN 120 AND 360) ORDER BY band, clip_id LIMIT 60""".replace("SELECT * FROM", "SELECT clip_id, chars FROM"))  # fmt: skip
def probe_chunks(spark, d):
    """Sixty probe texts, a sampling operator."""
    return reports.banded_pick(_clips(spark, d).select("clip_id", F.length("text").cast("long").alias("chars")), F.col("chars"), ["clip_id"], 60)


@query("""
    SELECT 'train' AS part_set, speaker, count(*) AS n FROM clips WHERE split = 'train' GROUP BY speaker UNION ALL SELECT 'held', speaker, count(*) FROM clips WHERE split <> 'train' GROUP BY speaker""")
def union_parts(spark, d):
    """J16."""
    c = _clips(spark, d)
    return reports.tagged_union({"train": c.where("split = 'train'"), "held": c.where("split <> 'train'")}).groupBy("part_set", "speaker").agg(F.count("*").alias("n"))


@query("""
    SELECT c.clip_id, p.max_chars FROM clips c JOIN profiles p ON c.profile = p.profile WHERE c.profile IS NOT NULL""")
def checked_profiles(spark, d):
    """Each clip with its profile; an unknown profile would fail."""
    return reports.checked_join(_clips(spark, d).where("profile is not null").select("clip_id", "profile"), table(spark, d, "profiles").select("profile", "max_chars"), "profile").select("clip_id", "max_chars")
