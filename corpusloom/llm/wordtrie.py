"""A corpus vocabulary as a distributed trie, and what it says of the last word of a text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checked_broadcast, materialize

#: A word with the mark that ends a sentence, if one follows it.
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*[.!?。！？]?")
_ENDS = ".!?。！？"
#: Distinct words a task holds before it hands over what it has counted; it changes no result.
FLUSH = 200_000
#: A word counts as known if it stands in the corpus more often than this share of the longer words that begin with it.
KNOWN_SHARE = 0.002
#: The same where last words are counted too: cut words end few texts besides the one asked for, whole ones many more.
KNOWN_LAST_SHARE = 0.1


def word_counts(texts: DataFrame, drop_last: bool = True) -> DataFrame:
    """word (lower case), n, n_end of the one text column of ``texts``: how often it stands in them and how often at
    the end of a sentence. A last word without a sentence end may be cut: it is not counted, or, unless ``drop_last``,
    counted in n_last. Null and empty texts have no words. Counts of parts add up; whole texts are read.

    Unless ``drop_last``, ``texts`` has distinct texts and a second column: how many rows each stands in. n, n_end and
    n_last count them all; once (last words too) and once_last count each distinct text once, so that copies add nothing."""
    kinds = ["n", "n_end", "n_last", "once", "once_last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        last: Counter = Counter()
        once: Counter = Counter()
        once_last: Counter = Counter()

        def flush() -> pa.RecordBatch:
            n: dict[str, list[int]] = {}
            for w, k in seen.items():
                end = w[-1] in _ENDS
                x = n.setdefault(w[:-1] if end else w, [0] * 5)
                x[0] += k
                x[1] += k * end
            for i, more in ((2, last), (3, once), (4, once_last)):
                for w, k in more.items():
                    n.setdefault(w.rstrip(_ENDS), [0] * 5)[i] += k
            words = list(n)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([n[w][i] for w in words], pa.int64()) for i in range(5))], names=["word", *kinds])

        for batch in batches:
            times = [1] * batch.num_rows if drop_last else batch.column(1).to_pylist()
            for text, k in zip(batch.column(0).to_pylist(), times):
                if text:
                    words = WORD.findall(text.lower())
                    if not drop_last:
                        once.update(words)
                    if words and words[-1][-1] not in _ENDS:
                        w = words.pop()
                        last[w] += k
                        once_last[w] += 1
                    if k == 1:
                        seen.update(words)
                    else:
                        for w in words:
                            seen[w] += k
            if len(seen) > FLUSH:
                yield flush()
                for x in (seen, last, once, once_last):
                    x.clear()
        yield flush()

    parts = texts.mapInArrow(run, "word string, " + ", ".join(f"{k} long" for k in kinds))
    counted = kinds[:2] if drop_last else kinds
    counts = parts.groupBy("word").agg(*(F.sum(k).alias(k) for k in counted))
    return counts.where("n > 0") if drop_last else counts


def last_words(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """For each distinct ``token`` (lower case) of ``tokens``: the counts of ``vocabulary``, below (how often longer
    words stand that begin with it) and cut: it is no word of the corpus but a proper prefix of some.

    The trie is a table of nodes (prefix, words below), built by an aggregation of the words' prefixes, so that it may be
    of any size; only the nodes of tokens are built. Words may be of any length."""
    distinct = materialize(tokens.where("token <> ''").select("token").distinct())
    lasts = "n_last" in vocabulary.columns
    n = F.col("n") + F.col("n_last") if lasts else F.col("n")
    words = vocabulary.select("word", n.alias("n"), *["once"] * lasts).where((F.col("n") >= 2) & (F.length("word") > 1))
    # Prefixes only of lengths that tokens have: one row, with a number for each length.
    sizes = distinct.agg(F.collect_set(F.length("token")).alias("_sizes"))
    cut = F.transform(F.filter("_sizes", lambda i: i < F.length("word")), lambda i: F.substring("word", F.lit(1), i))
    prefixes = words.crossJoin(F.broadcast(sizes)).select("n", *["once"] * lasts, F.explode(cut).alias("token")).join(checked_broadcast(distinct), "token", "left_semi")
    nodes = prefixes.groupBy("token").agg(F.sum("n").alias("below"), *[F.sum("once").alias("once_below")] * lasts)
    own = vocabulary.withColumnRenamed("word", "token")
    out = distinct.join(own, "token", "left").join(nodes, "token", "left").fillna(0)
    unknown = F.col("n") <= F.col("below") * KNOWN_SHARE
    if lasts:
        # A text does not vouch for its own last word, and its copies are no other texts.
        unknown = unknown & (F.col("once_last") - 1 <= F.col("once_below") * KNOWN_LAST_SHARE)
    return out.withColumn("cut", (F.col("below") >= 2) & unknown)
