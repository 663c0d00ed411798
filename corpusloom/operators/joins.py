"""Join forms: allow-lists, orphans, upsert, set containment, fuzzy names, n-gram seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import basename, edit_ratio, word_ngrams
from corpusloom.session import materialize


def restrict(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on the list."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def by_basename(files: DataFrame, rows: DataFrame, file: str, name: str) -> DataFrame:
    """``files`` with the row of ``rows`` whose file has the same base name; files without one, and rows without a file,
    are left out without a word. Columns that both have come from ``files``."""
    other = [c for c in rows.columns if c not in files.columns]
    right = rows.select(basename(F.col(name)).alias("_base"), *other)
    return files.withColumn("_base", basename(F.col(file))).join(right, "_base").drop("_base")


def todo(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no output yet; null keys stay."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def orphans(files: DataFrame, rows: DataFrame, ingested: DataFrame, key: str) -> DataFrame:
    """Key and where it is missing from: on disk, in the metadata, among the ingested. Complete keys are left out."""
    marks = [d.select(key).where(F.col(key).isNotNull()).distinct().withColumn(n, F.lit(True)) for d, n in ((files, "_f"), (rows, "_r"), (ingested, "_i"))]
    all_ = marks[0].join(marks[1], key, "full_outer").join(marks[2], key, "full_outer")
    absent = F.array_compact(F.array(F.when(F.col("_f").isNull(), "files"), F.when(F.col("_r").isNull(), "metadata"), F.when(F.col("_i").isNull(), "ingested")))
    return all_.select(key, F.array_join(absent, ",").alias("missing_from")).where("missing_from <> ''")


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """K8: ``base`` with the rows of ``changes`` put over it by key: non-null values win, other columns stay, new keys are added.

    Keys must be unique on each side; rows of ``base`` with a null key stay as they are."""
    new = [c for c in changes.columns if c not in base.columns]
    a, b = base.alias("a"), changes.alias("b")
    pick = [F.coalesce(f"b.{c}", f"a.{c}").alias(c) if c in changes.columns else F.col(f"a.{c}") for c in base.columns]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*pick, *(F.col(f"b.{c}") for c in new))


def contains_all(cues: DataFrame, cue_words: str, headings: DataFrame, heading_words: str, most: int = 12) -> DataFrame:
    """Cues of at most ``most`` words that hold all words of some heading. One word of a heading, the rarest among
    the cues, is the equi key, so no cue meets a heading it shares nothing with."""
    # Read twice below, so the rows are written with the number that tells them apart.
    short = materialize(cues.where((F.size(cue_words) > 0) & (F.size(cue_words) <= most)).withColumn("_c", F.monotonically_increasing_id()))
    words = short.select("_c", F.explode(F.array_distinct(F.col(cue_words))).alias("_w"))
    heads = headings.select(F.array_distinct(F.col(heading_words)).alias("_h")).where(F.size("_h") > 0).distinct()
    often = words.groupBy("_w").agg(F.count("*").alias("_n"))
    per = heads.withColumn("_w", F.explode("_h")).join(often, "_w", "left").groupBy("_h").agg(F.min_by("_w", F.struct(F.coalesce("_n", F.lit(0)), F.col("_w"))).alias("_w"))
    hit = words.join(per, "_w").join(short.select("_c", F.col(cue_words).alias("_cw")), "_c").where(F.size(F.array_except("_h", "_cw")) == 0).select("_c").distinct()
    return short.join(hit, "_c", "left_semi").drop("_c")


def _may_differ(longest: Column) -> Column:
    """Edits that an edit ratio of 0.3 leaves room for."""
    return F.floor(3 * longest / 10).cast("int")


def fuzzy_names(tokens: DataFrame, names: DataFrame, token: str = "token", name: str = "name") -> DataFrame:
    """For each distinct token the glossary name with the least edit ratio, if near enough: at most 0.20 for
    tokens of up to 5 characters, else 0.30; lengths at most 3 apart. Tokens under 4 characters, tokens that are names
    and those that differ only in punctuation or case give no row; ties go to the first name.

    A name within k edits of a token has one of its k + 1 pieces in it unchanged, at most k places away: names and tokens
    meet on (piece, place), an equi join, and only those that do are compared. No near name is missed."""
    t = tokens.select(token).where(F.length(token) >= 4).distinct().join(names.select(F.col(name).alias(token)).distinct(), token, "left_anti")
    n = names.select(name).where(F.length(name) >= 2).distinct()
    size, k = F.length(name), _may_differ(F.length(name) + 3)
    cut = lambda i: F.floor(i * size / (k + 1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(cut(i).alias("at"), F.substring(F.col(name), cut(i) + 1, cut(i + 1) - cut(i)).alias("piece")))
    places = n.select(name, k.alias("_k"), F.explode(pieces).alias("p")).select(name, "p.piece", F.explode(F.sequence(F.greatest(F.lit(0), F.col("p.at") - F.col("_k")), F.col("p.at") + F.col("_k"))).alias("at"))
    at = F.sequence(F.lit(0), F.length(token) - 1)
    parts = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.length(token) - i)), lambda w: F.struct(i.alias("at"), F.substring(F.col(token), i + 1, w).alias("piece")))))
    met = t.select(token, F.explode(parts).alias("p")).select(token, "p.piece", "p.at").join(places, ["piece", "at"]).where(F.abs(F.length(token) - F.length(name)) <= 3).select(token, name).distinct()
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    best = met.withColumn("ratio", edit_ratio(F.col(token), F.col(name))).groupBy(token).agg(F.min_by(name, F.struct("ratio", name)).alias(name), F.min("ratio").alias("ratio"))
    near = F.col("ratio") <= F.when(F.length(token) <= 5, 0.2).otherwise(0.3)
    return best.where(near & (F.col("ratio") > 0) & (bare(F.col(token)) != bare(F.col(name))))


def ngram_places(df: DataFrame, key: str, words: Column, n: int, most: int | None = None) -> DataFrame:
    """key, pos (from 0), g1, g2 (two hashes that stand for the n-gram, 12 bytes instead of its text).

    With ``most``, only n-grams that stand at most that often, counted where they meet: the hot ones go before any join."""
    hashed = F.transform(word_ngrams(words, n), lambda g: F.struct(F.xxhash64(g).alias("g1"), F.hash(g).alias("g2")))
    places = df.select(F.col(key), F.posexplode(hashed).alias("pos", "g")).select(key, "pos", "g.g1", "g.g2")
    if most is None:
        return places
    return places.withColumn("_n", F.count("*").over(Window.partitionBy("g1", "g2"))).where(F.col("_n") <= most).drop("_n")


def seeds(book: DataFrame, heard: DataFrame, n: int = 6, most: int = 6) -> DataFrame:
    """Shared n-grams of two tables of (key, words): book_key, heard_key, book_pos, heard_pos; n-grams that stand more
    than ``most`` times in the book are left out.

    The join is by sorting, as it stands: Spark takes the n-grams of a table for no more than its rows, and would broadcast them."""
    b = ngram_places(book, "book_key", F.col("words"), n, most)
    h = ngram_places(heard, "heard_key", F.col("words"), n)
    return h.withColumnRenamed("pos", "heard_pos").join(b.withColumnRenamed("pos", "book_pos").hint("merge"), ["g1", "g2"]).drop("g1", "g2")


def longest_runs(pairs: DataFrame, n: int = 6) -> DataFrame:
    """For each (book_key, heard_key) the longest exact run of words the seeds add up to: islands on a diagonal.

    Ties go to the earliest place in what was heard, then in the book. Returns book_pos, heard_pos and words."""
    diag = Window.partitionBy("book_key", "heard_key", "_d").orderBy("heard_pos")
    rows = pairs.withColumn("_d", F.col("book_pos") - F.col("heard_pos"))
    islands = rows.withColumn("_i", F.col("heard_pos") - F.row_number().over(diag))
    runs = islands.groupBy("book_key", "heard_key", "_d", "_i").agg(F.min("book_pos").alias("book_pos"), F.min("heard_pos").alias("heard_pos"), (F.count("*") + n - 1).cast("int").alias("words"))
    best = Window.partitionBy("book_key", "heard_key").orderBy(F.desc("words"), "heard_pos", "book_pos")
    return runs.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("book_key", "heard_key", "book_pos", "heard_pos", "words")
