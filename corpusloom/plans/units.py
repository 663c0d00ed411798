"""Queries of smaller operators: normalisers, sentence tests, gates, stages, chapters, spans, chat framing, costs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text, udfs
from corpusloom.operators import align, gates, joins, planner, reports, select, sft, stages
from corpusloom.plans.corpus import _WORDS, _clips, _docs, _words
from corpusloom.plans.registry import query
from corpusloom.session import table
from corpusloom.sources import sinks

# ---------------------------------------------------------------- normalisers and sentence tests

_N1 = "replace(translate(text, '{}', '{}'), '—', ' - ')".format(text.SMART[0], text.SMART[1].replace("'", "''"))
_N2 = rf"""
    w AS (SELECT clip_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT clip_id, string_split_regex(lower({_N1}), '[ \t\n\r/\-]+') AS ws FROM clips WHERE text IS NOT NULL)),
    b AS (SELECT clip_id, i, regexp_replace(w, '[^a-z0-9]', '', 'g') AS w FROM w),
    n AS (SELECT *, CASE WHEN regexp_full_match(w, '[0-9]{{1,4}}') THEN CAST(w AS INTEGER) END AS n FROM b),
    s AS (SELECT clip_id, i, CASE WHEN n IS NULL THEN w ELSE concat_ws(' ',
            CASE WHEN n >= 1000 THEN {text.ONES}[n // 1000 + 1] || ' thousand' END, CASE WHEN n % 1000 >= 100 THEN {text.ONES}[n % 1000 // 100 + 1] || ' hundred' END,
            CASE WHEN n % 100 >= 20 THEN {text.TENS}[n % 100 // 10 - 1] END,
            CASE WHEN n % 100 < 20 THEN CASE WHEN n % 100 > 0 OR n = 0 THEN {text.ONES}[n % 100 + 1] END WHEN n % 10 > 0 THEN {text.ONES}[n % 10 + 1] END) END AS w FROM n)"""


@query(f"WITH {_N2} SELECT clip_id, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE w <> ''), '') AS tokens FROM s GROUP BY clip_id")
def match_tokens(spark, d):
    """The tokens by which texts are matched."""
    return _clips(spark, d).where("text is not null").select("clip_id", F.array_join(text.match_tokens(F.col("text")), " ").alias("tokens"))


@query(f"SELECT word_id, {_N1.replace('text', 'word')} AS plain FROM anchored_words WHERE word IS NOT NULL")
def plain_signs(spark, d):
    """N1."""
    return table(spark, d, "anchored_words").where("word is not null").select("word_id", text.smart_chars(F.col("word")).alias("plain"))


_HEAD = r"string_split(text, chr(10))[1]"
_N7 = rf"list_filter(string_split_regex(regexp_replace(lower(regexp_replace({_HEAD}, '^[ \t]*[0-9IVXLC]+[:.][ \t]*', '')), '[^a-z0-9 ]', '', 'g'), ' +'), lambda x: x <> '')"


@query(f"SELECT doc_id, array_to_string({_N7}, ' ') AS heading FROM documents WHERE text IS NOT NULL")
def heading_tokens(spark, d):
    """N7 of the first line of each document."""
    return _docs(spark, d).select("doc_id", F.array_join(text.heading_tokens(F.substring_index("text", "\n", 1)), " ").alias("heading"))


@query(r"""
    SELECT doc_id, CAST(len(s) AS INTEGER) AS sentences, md5(array_to_string(list_transform(s, lambda x: trim(x, ' ')), '|')) AS said
    FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?]*[.!?]["”’'']*\s*') AS s FROM documents WHERE text IS NOT NULL)""")
def closed_sentences(spark, d):
    """sentences that are closed; a tail without an end is dropped."""
    s = text.closed_sentences(F.col("text"))
    return _docs(spark, d).select("doc_id", F.size(s).alias("sentences"), F.md5(F.array_join(s, "|")).alias("said"))


@query(r"SELECT word_id, regexp_matches(rtrim(word, ' '), '[.?!\"”)]$') AS ends, regexp_matches(word, '[0-9]') AS digits FROM anchored_words WHERE word IS NOT NULL".replace('\\"', '"'))
def sentence_ends(spark, d):
    """P2/P10."""
    w = table(spark, d, "anchored_words").where("word is not null")
    return w.select("word_id", text.ends_sentence(F.col("word")).alias("ends"), text.has_digit(F.col("word")).alias("digits"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '\[(?:break|pause)(?::[^\]]*)?\]', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')) AS text FROM documents WHERE text IS NOT NULL")
def without_markup(spark, d):
    """P14."""
    return _docs(spark, d).select("doc_id", F.md5(text.strip_markup(F.col("text"))).alias("text"))


# ---------------------------------------------------------------- gates and stages


@query("""
    SELECT clip_id, trailing_pause > 0.5 AND NOT (seconds * 84 >= least(3700, 2 * greatest(300, CAST(floor(length(text) / 18 * 86 * 1.6) AS INTEGER)))) AS passed,
           round(CASE WHEN seconds * 84 < 300 THEN 0.0 ELSE 2.0 * least(4.0, 1 + (seconds * 84 - 300) / greatest(300.0, length(text) / 18.4 * 84)) END, 6) AS boost
    FROM clips WHERE text IS NOT NULL AND seconds IS NOT NULL AND trailing_pause IS NOT NULL""")
def eos_gate(spark, d):
    """Clips as renderings that stopped if they end in a pause."""
    c = _clips(spark, d).where("text is not null and seconds is not null and trailing_pause is not null")
    tokens, chars = F.col("seconds") * 84, F.length("text")
    boost = gates.eos_ramp(tokens, F.lit(300), gates.expected_tokens(chars), 2.0)
    return c.select("clip_id", gates.eos_verdict(F.col("trailing_pause") > 0.5, tokens, chars).alias("passed"), F.round(boost, 6).alias("boost"))


_OFFSETS = f"""
    WITH {_WORDS}, g AS (SELECT stem, start_s - lag(end_s) OVER (PARTITION BY stem ORDER BY pos) AS x, source FROM w),
    o AS (SELECT stem, abs(x) AS x, row_number() OVER (PARTITION BY stem ORDER BY abs(x) NULLS LAST) - 1 AS i, count(x) OVER (PARTITION BY stem) AS n FROM g),
    s AS (SELECT stem, count(x) AS usable, count(*) - count(x) AS skipped, quantile_cont(x, 0.5) AS medoff, max(x) AS maxoff, max(x) FILTER (WHERE i = CAST(round_even(0.95 * (n - 1), 0) AS BIGINT)) AS p95off FROM o GROUP BY stem)"""


def _offsets(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("start_s") - F.lag("end_s").over(Window.partitionBy("stem").orderBy("pos"))
    return align.offset_stats(_words(spark, d).select("stem", x.alias("x")), ["stem"], "x")


@query(_OFFSETS + " SELECT stem, usable, skipped, round(medoff, 6) AS medoff, round(maxoff, 6) AS maxoff, round(p95off, 6) AS p95off FROM s")
def offset_stats(spark, d):
    """The gaps between neighbouring words as offsets."""
    return _offsets(spark, d).select("stem", "usable", "skipped", *(F.round(c, 6).alias(c) for c in ("medoff", "maxoff", "p95off")))


@query(_OFFSETS + """
    SELECT stem, concat_ws('|', CASE WHEN maxoff > 1.5 THEN 'offset' END, CASE WHEN maxoff > 3 AND skipped = 0 THEN 'drift, nothing corrected' END, CASE WHEN usable > 3 THEN 'correction threshold too loose' END,
           CASE WHEN usable > 0 AND medoff < 0.4 THEN 'boundaries away from silence' END) AS failures, concat_ws('|', CASE WHEN maxoff > 0.75 THEN 'offset' END, CASE WHEN p95off > 0.75 THEN 'drift p95' END) AS warnings FROM s""")
def verify_gate(spark, d):
    """A verification of each source: its gaps as offsets, its share near silence by the median."""
    s = _offsets(spark, d)
    fails = gates.verify_failures(F.col("maxoff"), F.col("maxoff"), F.col("skipped"), F.col("usable").cast("double"), F.col("usable"), F.col("medoff"))
    return s.select("stem", F.array_join(fails, "|").alias("failures"), F.array_join(gates.verify_warnings(F.col("maxoff"), F.col("p95off")), "|").alias("warnings"))


_STATES = """
    WITH i AS (SELECT source AS part_set, CASE WHEN kind IN ('vtt', 'captions') THEN 'align' ELSE 'cut' END AS stage, sum(n_chars) AS size, count(*) AS mtime_ns, count(text) AS n FROM documents WHERE source IS NOT NULL GROUP BY ALL),
    r AS (SELECT source AS part_set, CASE WHEN kind IN ('vtt', 'captions') THEN 'align' ELSE 'cut' END AS stage, sum(n_chars) AS size, count(*) AS mtime_ns, count(lang) AS n, count(*) >= 20 AS passed FROM documents WHERE source IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    s AS (SELECT i.part_set, i.stage, CASE WHEN r.passed IS NULL THEN 'missing' WHEN NOT r.passed THEN 'failed' WHEN i.size IS DISTINCT FROM r.size OR i.n IS DISTINCT FROM r.n THEN 'stale' ELSE 'done' END AS state
          FROM i LEFT JOIN r ON i.part_set = r.part_set AND i.stage = r.stage)"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("source is not null")
    by = docs.groupBy(F.col("source").alias("part_set"), F.when(F.col("kind").isin("vtt", "captions"), "align").otherwise("cut").alias("stage"))
    size, rows = F.sum("n_chars").alias("size"), F.count("*").alias("mtime_ns")
    return stages.stage_states(by.agg(size, rows, F.count("text").alias("n")), by.agg(size, rows, F.count("lang").alias("n"), (F.count("*") >= 20).alias("passed")).where("mtime_ns >= 10"))


@query(_STATES + " SELECT part_set, stage, state FROM s")
def stage_states(spark, d):
    """What has been done for the documents of each source; a record for other inputs is stale."""
    return _states(spark, d)


@query(_STATES + ", o AS (SELECT *, CASE stage WHEN 'align' THEN 2 ELSE 4 END AS o FROM s) SELECT part_set, min_by(stage, o) FILTER (WHERE state <> 'done') AS next_stage FROM o GROUP BY part_set")
def next_stages(spark, d):
    """The first stage of each source that is not done."""
    return stages.next_stages(_states(spark, d))


@query("""
    WITH e AS (SELECT user_id, CAST(floor(value / 100) AS BIGINT) AS x, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE value IS NOT NULL),
    t AS (SELECT user_id, x, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM e WHERE r <= 70), g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, x ORDER BY i) AS island FROM t),
    l AS (SELECT user_id, max(n) AS longest FROM (SELECT user_id, count(*) AS n FROM g GROUP BY user_id, x, island) GROUP BY user_id)
    SELECT user_id, CAST(count(DISTINCT x) AS INTEGER) AS "unique", CAST(any_value(longest) AS INTEGER) AS longest FROM t JOIN l USING (user_id) GROUP BY user_id""")
def tail_loops(spark, d):
    """The last 70 frames of each stream."""
    e = table(spark, d, "events").where("value is not null").withColumn("x", F.floor(F.col("value") / 100))
    last = e.withColumn("_r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("event_id")))).where("_r <= 70")
    ids = last.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "x"))), lambda v: v["x"]).alias("ids"))  # 70 at most
    return ids.select("user_id", gates.tail_loop(F.col("ids")).alias("t")).select("user_id", "t.unique", "t.longest")


@query("SELECT name, distance FROM (SELECT event_type AS name, round(abs(avg(value) - 100), 6) AS distance, max(value) AS m FROM events GROUP BY event_type) WHERE m >= 100 ORDER BY distance, name LIMIT 1")
def best_epoch(spark, d):
    """The safe event type nearest to a mean of 100."""
    e = table(spark, d, "events").groupBy(F.col("event_type").alias("name")).agg(F.round(F.abs(F.avg("value") - 100), 6).alias("distance"), F.max("value").alias("m"))
    return gates.best_epoch(e, "name", F.col("m") < 100)


# ---------------------------------------------------------------- chapters, headings, spans


@query("WITH " + _WORDS + """, m AS (SELECT stem, max(pos) AS last FROM w GROUP BY stem)
    SELECT w.stem, w.pos, CASE WHEN w.pos % 100 < 80 THEN w.pos // 100 ELSE m.last // 100 END AS chapter FROM w JOIN m ON m.stem = w.stem""")
def chapters_of_words(spark, d):
    """Chapters of 80 words with 20 words between them; what lies in none goes to the last."""
    w = _words(spark, d).where("stem is not null").select("stem", "pos", F.col("pos").alias("book_idx"))
    last = w.groupBy("stem").agg(F.max("pos").alias("last"))
    chapters = last.select("stem", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / 100).cast("int"))).alias("chapter"))
    chapters = chapters.select("stem", "chapter", (F.col("chapter") * 100).alias("word_start"), (F.col("chapter") * 100 + 80).alias("word_end"))
    return align.chapter_of(w, chapters, "stem").select("stem", "pos", "chapter")


_N4 = r"list_filter(string_split_regex(regexp_replace(replace(lower(text), '-', ' '), '[^a-z0-9 \t\n\r'']', ' ', 'g'), '[ \t\n\r]+'), lambda x: x <> '')"


@query(f"""
    WITH h AS (SELECT DISTINCT ({_N7})[1:1] AS h FROM documents WHERE text IS NOT NULL AND kind = 'chapter'), c AS (SELECT clip_id, {_N4} AS w FROM clips WHERE text IS NOT NULL)
    SELECT DISTINCT clip_id FROM c, h WHERE len(w) BETWEEN 1 AND 12 AND len(h) = 1 AND list_has_all(w, h)""")
def heading_cues(spark, d):
    """Short clips that hold the first word of some chapter's heading."""
    words = F.slice(text.heading_tokens(F.substring_index("text", "\n", 1)), 1, 1)
    heads = _docs(spark, d).where("kind = 'chapter'").select(words.alias("h")).where(F.size("h") == 1)
    cues = _clips(spark, d).where("text is not null").select("clip_id", text.cue_tokens(F.col("text")).alias("w"))
    return joins.contains_all(cues, "w", heads, "h").select("clip_id")


@query("SELECT s.stem, min(c.clip_id) AS clip_id FROM (SELECT DISTINCT stem FROM anchored_words WHERE stem IS NOT NULL) s JOIN clips c ON regexp_replace(lower(c.stem), '[^a-z0-9]', '', 'g') = regexp_replace(lower(s.stem), '[^a-z0-9]', '', 'g') GROUP BY s.stem")
def first_clip_of_source(spark, d):
    """Each source with its first clip, by a normalised key."""
    sources = table(spark, d, "anchored_words").where("stem is not null").select("stem").distinct()
    clips = table(spark, d, "clips").where("stem is not null").select(F.col("stem").alias("file"), "clip_id")
    return reports.first_match(sources, clips, text.bare_word(F.col("stem")), text.bare_word(F.col("file")), ["clip_id"]).select("stem", "clip_id")


@query("SELECT c.clip_id, p.name, substring(c.text, p.a + 1, p.b - p.a) AS text FROM clips c, (VALUES ('head', 0, 10), ('rest', 10, 40)) p(name, a, b) WHERE c.text IS NOT NULL")
def text_slices(spark, d):
    """Texts cut again by recorded offsets."""
    c = _clips(spark, d).where("text is not null").select("clip_id", "text")
    marks = F.array(F.struct(F.lit("head").alias("name"), F.lit(0).alias("start"), F.lit(10).alias("end")), F.struct(F.lit("rest").alias("name"), F.lit(10).alias("start"), F.lit(40).alias("end")))
    return reports.slices(c, c.select("clip_id", F.explode(marks).alias("m")).select("clip_id", "m.*"), "clip_id")


@query("WITH " + _WORDS + """,
    n AS (SELECT stem, start_s, end_s, in_sfx_keepout, row_number() OVER (PARTITION BY stem ORDER BY pos) AS i FROM w),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY stem ORDER BY i) AS island FROM n WHERE NOT in_sfx_keepout),
    r AS (SELECT stem, min(start_s) AS start, max(end_s) AS "end" FROM g GROUP BY stem, island)
    SELECT stem, round(start, 6) AS start, round("end", 6) AS "end" FROM r WHERE "end" - start >= 15""")
def narration_runs(spark, d):
    """Runs of words outside kept-out regions, of 15 seconds or more."""
    w = _words(spark, d).select("stem", F.col("pos").alias("cue_idx"), F.col("start_s").alias("start"), F.col("end_s").alias("end"), F.col("in_sfx_keepout").alias("in_quote"))
    return reports.narration_runs(w, "stem").select("stem", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("WITH " + _WORDS + """,
    r AS (SELECT stem, pos, start_s, end_s, source = 'whisper' AS hit, row_number() OVER (PARTITION BY stem ORDER BY pos) - 1 AS i FROM w),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY stem ORDER BY pos) AS island FROM r WHERE hit),
    s AS (SELECT stem, min(i) AS first_row, max(i) AS last_row, count(*) AS n, min(start_s) AS a, max(end_s) AS b FROM g GROUP BY stem, island)
    SELECT stem, first_row, n, round(b - a, 6) AS seconds FROM s WHERE n >= 5 OR b - a >= 2""")
def notable_stretches(spark, d):
    """Q5: stretches that were only heard, of five words or two seconds."""
    return align.heard_stretches(_words(spark, d), "stem").select("stem", "first_row", "n", F.round("seconds", 6).alias("seconds"))


@query("WITH " + _WORDS + """,
    v AS (SELECT stem, pos, word, start_s - lag(end_s) OVER o AS gap, source = 'whisper' AS off, lag(source = 'whisper') OVER o AS was, lead(source = 'whisper') OVER o AS nxt
          FROM w WHERE word IS NOT NULL AND start_s IS NOT NULL AND end_s IS NOT NULL AND source IS NOT NULL WINDOW o AS (PARTITION BY stem ORDER BY pos))
    SELECT stem, string_agg((CASE WHEN gap >= 1.5 THEN chr(10) || chr(10) WHEN gap IS NULL THEN '' ELSE ' ' END) || (CASE WHEN off AND NOT coalesce(was, false) THEN '[' ELSE '' END) || word
                            || (CASE WHEN off AND NOT coalesce(nxt, false) THEN ']' ELSE '' END), '' ORDER BY pos) AS text FROM v GROUP BY stem""")
def transcripts(spark, d):
    """K4: readable transcripts, what was only heard in brackets."""
    w = _words(spark, d).where("word is not null and start_s is not null and end_s is not null and source is not null")
    return sinks.transcript(w.select("stem", "pos", "word", "start_s", "end_s", "source"), "stem")


@query("""
    WITH r AS (SELECT clip_id, row_number() OVER (ORDER BY clip_id) - 1 AS i, count(*) OVER () AS n, least(1.0, 30000000 / sum(ms) OVER ()) AS share FROM (SELECT clip_id, CAST(round(seconds * 1000) AS BIGINT) AS ms FROM clips WHERE seconds IS NOT NULL)),
    k AS (SELECT *, CAST(round_even(n * share, 0) AS BIGINT) AS k FROM r),
    x AS (SELECT DISTINCT CAST(round_even(j * ((n - 1) / CAST(k - 1 AS DOUBLE)), 0) AS BIGINT) AS i FROM (SELECT DISTINCT n, k FROM k), LATERAL (SELECT unnest(range(0, k)) AS j) UNION SELECT DISTINCT n - 1 FROM k)
    SELECT clip_id FROM k WHERE i IN (SELECT i FROM x)""")
def spread_subset(spark, d):
    """Clips of about 500 minutes, evenly spread."""
    c = _clips(spark, d).where("seconds is not null").select("clip_id", F.round(F.col("seconds") * 1000).cast("long").alias("ms"))
    return reports.spread_subset(c, ["clip_id"], "ms", 30_000_000.0).select("clip_id")


# ---------------------------------------------------------------- chat framing, costs, tasks


@query("""
    SELECT clip_id, CAST(len(t) + 5 + k + 2 AS INTEGER) AS ids, CAST(len(t) + 5 AS INTEGER) AS masked, CAST(list_sum(t) + 128259 + 128009 + 128260 + 128261 + 128257 + k * 128266 + 128258 + 128262 AS BIGINT) AS total
    FROM (SELECT clip_id, range(1, length(text) + 1) AS t, CAST(floor(seconds) AS BIGINT) * 7 AS k FROM clips WHERE length(text) > 0 AND seconds >= 1)""")
def framed_prompts(spark, d):
    """Texts and codes between their special ids; the prompt is masked."""
    c = _clips(spark, d).where("length(text) > 0 and seconds >= 1")
    ids, labels = sft.framed_prompt(F.sequence(F.lit(1), F.length("text")), F.array_repeat(F.lit(sft.CODE_BASE), (F.floor("seconds") * 7).cast("int")))
    total = F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x)
    return c.select("clip_id", F.size(ids).alias("ids"), F.size(F.filter(labels, lambda x: x == sft.IGNORED)).alias("masked"), total.alias("total"))


@query("SELECT profile, CAST(floor(3 * count(*) / 4) AS BIGINT) AS steps FROM clips WHERE profile IS NOT NULL GROUP BY profile")
def training_steps(spark, d):
    """E5: three epochs in batches of four."""
    return _clips(spark, d).where("profile is not null").groupBy("profile").agg(sft.steps(F.lit(3), F.count("*"), F.lit(4)).alias("steps"))


@query("SELECT doc_id FROM documents WHERE starts_with(kind, 'chat') UNION ALL SELECT doc_id FROM documents WHERE starts_with(kind, 'chat') AND text IS NOT NULL")
def task_slice(spark, d):
    """The rows of one task from two tables."""
    docs = table(spark, d, "documents").select("doc_id", F.col("kind").alias("task"), F.col("source").alias("provenance"), "text")
    return sft.task_slice([docs, docs.where("text is not null")], "chat", "doc_id").select("doc_id")


@query("WITH " + _WORDS + """, c AS (SELECT stem, round((end_s - start_s) * 1000) AS s, CASE WHEN source = 'book' THEN 'accepted' WHEN in_sfx_keepout THEN 'rejected' ELSE 'idle' END AS state FROM w)
    SELECT stem, sum(s) AS ms, round(sum(CASE WHEN state = 'accepted' THEN s ELSE 0 END) / sum(s), 6) AS accepted, round(sum(CASE WHEN state = 'rejected' THEN s ELSE 0 END) / sum(s), 6) AS rejected,
           round(sum(CASE WHEN state = 'idle' THEN s ELSE 0 END) / sum(s), 6) AS idle FROM c GROUP BY stem""")
def cost_shares(spark, d):
    """How the time of each source is spent."""
    state = F.when(F.col("source") == "book", "accepted").when(F.col("in_sfx_keepout"), "rejected").otherwise("idle")
    rows = _words(spark, d).select("stem", F.round((F.col("end_s") - F.col("start_s")) * 1000).alias("seconds"), state.alias("state"))
    return reports.cost_shares(rows, ["stem"]).select("stem", F.col("seconds").alias("ms"), "accepted", "rejected", "idle")


@query("SELECT clip_id, round(greatest(0.0, 0.75 * seconds / 10 - trailing_pause), 6) AS gap FROM clips WHERE seconds IS NOT NULL AND trailing_pause IS NOT NULL")
def assembly_gaps(spark, d):
    """X5."""
    c = _clips(spark, d).where("seconds is not null and trailing_pause is not null")
    return c.select("clip_id", F.round(reports.assembly_gap(F.col("seconds") / 10, F.col("trailing_pause")), 6).alias("gap"))


@query("SELECT clip_id, '/mnt/d/corpus/' || audio_file AS path FROM clips WHERE audio_file IS NOT NULL")
def mounted_paths(spark, d):
    """F19."""
    c = table(spark, d, "clips").where("audio_file is not null")
    return c.select("clip_id", text.wsl_path(F.concat(F.lit("D:\\\\corpus\\"), F.replace("audio_file", F.lit("/"), F.lit("\\")))).alias("path"))


_BASE = r"regexp_replace(regexp_replace({}.audio_file, '^.*/', ''), '\.[^.]*$', '')"


@query(f"SELECT a.clip_id, b.text FROM clips a JOIN clips b ON b.text IS NOT NULL AND b.split = 'train' AND {_BASE.format('a')} = {_BASE.format('b')}")
def texts_by_basename(spark, d):
    """Audio files with their texts of the training metadata, by base name."""
    c = table(spark, d, "clips")
    rows = c.where("text is not null and split = 'train'").select(F.regexp_replace("audio_file", "^wavs/", "train/").alias("name"), "text")
    return joins.by_basename(c.select("clip_id", "audio_file"), rows, "audio_file", "name").select("clip_id", "text")


@query("""
    WITH b AS (SELECT CASE WHEN seconds >= 1.5 AND seconds < 3 THEN 1.5 WHEN seconds >= 3 AND seconds < 10 THEN 3 WHEN seconds >= 10 AND seconds < 20 THEN 10 END AS lo, seconds FROM clips),
    g AS (SELECT lo, count(*) AS clips, sum(seconds) / 60 AS minutes FROM b WHERE lo IS NOT NULL GROUP BY lo)
    SELECT CAST(p.lo AS DOUBLE) AS lo, CAST(p.hi AS DOUBLE) AS hi, round(p.w / 6.0, 6) AS wanted, coalesce(clips, 0) AS clips, round(coalesce(minutes, 0), 6) AS minutes, round(coalesce(clips, 0) / (SELECT sum(clips) FROM g), 6) AS share
    FROM (VALUES (1.5, 3, 1), (3, 10, 2), (10, 20, 3)) p(lo, hi, w) LEFT JOIN g ON g.lo = p.lo""")
def length_mix(spark, d):
    """Clips of 1.5-3, 3-10 and 10-20 s in the ratio 1:2:3."""
    out = select.mix_report(_clips(spark, d), "seconds", [(1, 1.5, 3), (2, 3, 10), (3, 10, 20)])
    return out.select("lo", "hi", F.round("wanted", 6).alias("wanted"), "clips", F.round("minutes", 6).alias("minutes"), F.round("share", 6).alias("share"))


@query()
def seed_set(spark, d):
    """X10."""
    return reports.seed_set(_clips(spark, d).select("clip_id", "seconds"), ["clip_id"], "seconds").select("clip_id", "seconds")


@query()
def transcript_fidelity(spark, d):
    """Book words of each source as written against all of its words as heard."""
    w = _words(spark, d).where("stem is not null and word is not null").select("stem", "pos", text.bare_word(F.col("word")).alias("w"), "source").where("w <> ''")
    hour = w.withColumn("part", F.floor(F.col("pos") / 50))
    said = lambda df, name: df.groupBy("stem", "part").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "w"))), lambda x: x["w"]).alias(name))
    both = said(hour.where("source = 'book'"), "want").join(said(hour, "got"), ["stem", "part"])  # 50 words at most
    return gates.transcript_fidelity(both, udfs.wer(F.col("want"), F.col("got")), F.col("want"), F.col("got"))


# ---------------------------------------------------------------- alignment and planning, tested against plain loops


def _book_and_heard(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The book words of each source, numbered from 0, and what was heard of the source: every word but the first ten."""
    w = _words(spark, d).where("word is not null and start_s is not null and end_s is not null and stem is not null")
    at = F.row_number().over(Window.partitionBy("stem").orderBy("pos")) - 1
    book = w.where("source = 'book'").select("stem", at.alias("pos"), "word")
    heard = w.withColumn("pos", at - 10).where("pos >= 0").select("stem", "pos", "word", F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    return book, heard


@query("WITH " + _WORDS + """, v AS (SELECT * FROM w WHERE word IS NOT NULL AND start_s IS NOT NULL AND end_s IS NOT NULL AND stem IS NOT NULL),
    b AS (SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY pos) - 1 AS a, regexp_replace(lower(word), '[^a-z0-9]', '', 'g') AS k FROM v WHERE source = 'book'),
    h AS (SELECT * FROM (SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY pos) - 11 AS b, regexp_replace(lower(word), '[^a-z0-9]', '', 'g') AS k FROM v) WHERE b BETWEEN 0 AND 119),
    p AS (SELECT b.stem, a, b, a - b AS diag FROM b JOIN h ON b.stem = h.stem AND b.k = h.k), r AS (SELECT *, b - row_number() OVER (PARTITION BY stem, diag ORDER BY b) AS island FROM p),
    s AS (SELECT stem, min(a) AS a, min(b) AS b, count(*) AS size FROM r GROUP BY stem, diag, island), t AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY size DESC, a, b) AS rn FROM s)
    SELECT x.stem, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(size, 0) AS size, greatest(0, coalesce(a, 0) - coalesce(b, 0) - 15) AS start FROM (SELECT DISTINCT stem FROM b) x LEFT JOIN t ON t.stem = x.stem AND rn = 1""")
def auto_anchor(spark, d):
    """Q1."""
    return align.auto_anchor(*_book_and_heard(spark, d), "stem").select("stem", *(F.col(c).cast("long").alias(c) for c in ("a", "b", "size", "start")))


@query()
def align_window(spark, d):
    """Q2."""
    return align.align_window(*_book_and_heard(spark, d), "stem")


@query()
def tightened_ends(spark, d):
    """Q6: where the first thirty book words of each source end among the first words heard of it."""
    w = _words(spark, d).where("word is not null and end_s is not null and stem is not null").withColumn("w", text.bare_word(F.col("word"))).where("w <> ''")
    at = F.row_number().over(Window.partitionBy("stem").orderBy("pos"))
    packed = lambda df, most, name: df.withColumn("_n", at).where(F.col("_n") <= most).groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("pos", "w", F.col("end_s").alias("end")))).alias(name))
    both = packed(w.where("source = 'book'"), 30, "b").join(packed(w, 200, "h"), "stem")
    heard = F.transform("h", lambda x: F.struct(x["w"].alias("w"), x["end"].alias("end")))
    return both.select("stem", align.tightened_end(F.col("b.w"), heard).alias("end"))


def _spans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w = _words(spark, d).where("start_s is not null and end_s is not null and stem is not null")
    nxt = F.lead("start_s").over(Window.partitionBy("stem").orderBy("pos"))
    spans = w.select("stem", F.col("start_s").alias("a"), F.col("end_s").alias("b"))
    return spans, w.select("stem", F.col("end_s").alias("g0"), nxt.alias("g1")).where("g0 < g1")


@query()
def merged_spans(spark, d):
    """Words as spans of 8 seconds or so."""
    return planner.merged_spans(_spans(spark, d)[0], "stem", 8.0, 15.0)


@query()
def split_spans(spark, d):
    """Whole sources cut at their longest gaps until no part is over 15 seconds."""
    spans, gaps = _spans(spark, d)
    return planner.split_spans(spans.groupBy("stem").agg(F.min("a").alias("a"), F.max("b").alias("b")), gaps, "stem", 15.0)


@query()
def probe_picks(spark, d):
    """A word to probe about every minute."""
    return planner.probes(_words(spark, d).where("stem is not null").select("stem", "pos", "start_s"), "stem", "start_s", 60.0).select("stem", "pos", "probe")


@query()
def opening_offsets(spark, d):
    """Every sentence of the book against what was heard within a minute of it."""
    w = _words(spark, d).where("stem is not null and word is not null and start_s is not null")
    by = Window.partitionBy("stem").orderBy("pos")
    token = text.bare_word(F.col("word"))
    opens = F.coalesce(F.lag(text.ends_sentence(F.col("word"))).over(by), F.lit(True))
    rows = w.select("stem", "pos", token.alias("token"), F.col("start_s").alias("at"), F.collect_list(token).over(by.rowsBetween(0, 5)).alias("tokens"), opens.alias("opens"))
    cues = rows.where("opens").select("stem", F.col("pos").alias("cue"), F.col("at").alias("start"), "tokens")
    return planner.opening_offsets(cues, rows.select("stem", "pos", "token", "at"), "stem", "cue", 60.0)


@query()
def capped_parts(spark, d):
    """Clips of each source in parts of ten minutes at most."""
    c = _clips(spark, d).where("stem is not null").select("stem", "clip_id", "seconds")
    return planner.capped_parts(c, "stem", "clip_id", "seconds", 600.0).select("stem", "clip_id", "part")


@query("WITH " + _WORDS + r""",
    f AS (SELECT *, regexp_replace(lower(word), '[^a-z0-9]', '', 'g') = 'echoed' AS hit FROM w WHERE word IS NOT NULL AND start_s IS NOT NULL AND end_s IS NOT NULL)
    SELECT stem, pos, part, CASE WHEN NOT hit THEN word WHEN part = 0 THEN regexp_extract(word, '^[^\p{L}\p{N}_]*') || 'ech' ELSE 'oed' || regexp_extract(word, '[^\p{L}\p{N}_]*$') END AS word,
           CASE WHEN hit AND part = 1 THEN round(start_s + (end_s - start_s) / 2, 3) ELSE start_s END AS start_s FROM f, (VALUES (0), (1)) p(part) WHERE hit OR part = 0""".replace("\\\\", "\\"))
def fused_words(spark, d):
    """a word that is written as two, its time shared out."""
    w = _words(spark, d).where("word is not null and start_s is not null and end_s is not null").select("stem", "pos", "word", F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    fixes = spark.createDataFrame([("echoed", ["ech", "oed"])], "token string, parts array<string>")
    return align.split_fused(w, fixes).select("stem", "pos", "part", "word", F.col("start").alias("start_s"))
