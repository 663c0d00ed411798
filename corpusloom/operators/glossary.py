"""Proper nouns of a corpus (A9): capitalised words by frequency rules, against the corpus' own lower-case vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Capitalised words that are no names.
COMMON = (
    "The A An And But Or Nor For Yet So He She It They We You I His Her Its Their Our Your My Him Them Us Me When While Then There Here Now If As At In On Of To By With From That This These Those "
    "What Who Whom Which Why How Not No Yes Well Oh Ah Come Go Get Let Do Did Was Were Is Are Be Been Had Has Have Will Would Could Should Can May Might Must Said One Two Three First Last Some All "
    "Any Each Every Only Even Still Just Because After Before Once Again Very Most More Down Up Out Over Under"
).split()
ORDINARY, LEAST = 5, 2
# Contractions that are no names; so is any word with "n't".
CONTRACTIONS = ("i'm", "i'll", "i'd", "i've")


def core(word: Column) -> Column:
    """A word without signs around it, a possessive or a trailing apostrophe."""
    bare = F.regexp_replace(word, r"^[^A-Za-z]+|[^A-Za-z'\-]+$", "")
    return F.regexp_replace(F.regexp_replace(bare, "'s$", ""), "'+$", "")


def glossary(df: DataFrame, text: str) -> DataFrame:
    """name, n: words of 3 letters or more that begin with a capital, are no contraction, not COMMON nor seen in lower case
    ORDINARY times, and stand LEAST times and never first in a sentence, or 4 times, or LEAST times with an apostrophe or hyphen.

    One pass per statistic, each an aggregate that combines before its shuffle; nothing is collected."""
    words = df.select(F.explode(F.split(F.translate(text, "’", "'"), r"[ \t\n\r]+")).alias("raw"))
    single = words.select(core(F.col("raw")).alias("name")).where((F.length("name") >= 3) & F.col("name").rlike("^[A-Z]") & ~F.col("name").isin(COMMON) & ~F.lower("name").contains("n't") & ~F.lower("name").isin(*CONTRACTIONS))
    counts = single.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    pieces = df.select(F.explode(F.split(F.translate(text, "’", "'"), r"[.!?]+")).alias("s"))
    initial = pieces.select(F.regexp_extract("s", r"[A-Za-z][A-Za-z'\-]+", 0).alias("name")).where("name <> ''").distinct().withColumn("_first", F.lit(True))
    kept = counts.join(initial, "name", "left").where(F.col("_first").isNull() | (F.col("n") >= 4) | F.col("name").rlike("['-]"))
    return kept.join(_ordinary(df, text), F.lower("name") == F.col("_w"), "left_anti").select("name", "n")


def glossary_pairs(df: DataFrame, text: str) -> DataFrame:
    """name, n: two adjacent words that both begin with a capital and are neither COMMON nor seen in lower case ORDINARY
    times, LEAST times or more. Words have two letters or more and lose their possessive; pairs overlap, go on over the
    signs between two words, sentence ends included, but not from one text to the next."""
    words = F.regexp_extract_all(F.translate(text, "’", "'"), F.lit(r"[A-Za-z][A-Za-z'\-]+"), F.lit(0))
    bare = F.transform(words, lambda w: F.regexp_replace(F.regexp_replace(w, "'s$", ""), "'+$", ""))
    is_name = lambda w: w.rlike("^[A-Z]") & ~w.isin(COMMON)
    both = F.filter(F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0))).alias("b")), lambda p: is_name(p["a"]) & is_name(p["b"]))
    counts = df.select(bare.alias("_w")).select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    for side in ("a", "b"):
        counts = counts.join(_ordinary(df, text), F.lower(side) == F.col("_w"), "left_anti")
    return counts.select(F.concat_ws(" ", "a", "b").alias("name"), "n")


def _ordinary(df: DataFrame, text: str) -> DataFrame:
    """_w: the words seen in lower case ORDINARY times."""
    lower = df.select(F.explode(F.regexp_extract_all(F.translate(text, "’", "'"), F.lit(r"[A-Za-z][A-Za-z']+"), F.lit(0))).alias("w")).where(F.col("w").rlike("^[a-z]"))
    return lower.groupBy(F.lower("w").alias("_w")).agg(F.count("*").alias("_n")).where(F.col("_n") >= ORDINARY).select("_w")
