"""Lines repeated across one source's documents: mergeable heavy-hitter summaries, exact second pass, removal."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checked_broadcast, fits_broadcast, materialize, written

#: Where the defaults of min_docs and min_share come from: the statement of the problem.
MIN_DOCS, MIN_SHARE = 5, 0.05
#: A partition's summary of a source keeps counts with an error of at most this part of ``min_share`` times its documents.
SLACK = 0.5


def line_key(line: Column) -> Column:
    """The form in which two lines are compared: no letter case (capitals of ß are SS), no outer white space, one blank for inner white space."""
    return F.replace(F.lower(F.trim(F.regexp_replace(line, r"(?U)[\s\u001c-\u001f]+", " "))), F.lit("ß"), F.lit("ss"))


def line_hashes(text: Column) -> Column:
    """A 64-bit hash of the compared form of each line, null for blank ones."""
    return F.transform(F.split(text, "\n"), lambda x: _hash_or_null(x))


def _hash_or_null(line: Column) -> Column:
    return F.get(F.transform(F.array(line_key(line)), lambda k: F.when(k != "", F.xxhash64(k))), F.lit(0))


class Summary:
    """Misra-Gries counters of one source in one partition. ``docs`` and ``items`` size it, so that the error stays near
    SLACK * min_share * docs (at most items / (counters + 1) is taken from any count); ``taken`` is the error it has."""

    def __init__(self, min_share: float):
        self.share, self.docs, self.items, self.taken, self.counts = min_share * SLACK, 0, 0, 0, {}

    def add(self, hashes, counts, docs: int) -> None:
        self.docs += docs
        self.items += int(counts.sum())
        get = self.counts.get
        for h, n in zip(hashes.tolist(), counts.tolist()):
            self.counts[h] = get(h, 0) + n
        keep = int(self.items / (self.share * self.docs)) + 1
        if len(self.counts) > 2 * keep:  # Misra-Gries: take the (keep+1)-th largest count from all
            cut = sorted(self.counts.values(), reverse=True)[keep]
            self.taken += cut
            self.counts = {h: n - cut for h, n in self.counts.items() if n > cut}


def summarize(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """Mergeable summaries of (source, hs array<long>): rows (source, h, n), and one (source, null, e) where e is how much
    too low any n of this part may be. ``docs`` has one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        by: dict[object, Summary] = {}
        for batch in batches:
            source, lists = batch.column(0).dictionary_encode(), batch.column(1)
            codes = source.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(codes, sizes)
            order = np.lexsort((flat, owner))
            o, f = owner[order], flat[order]
            new = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (f[1:] != f[:-1])))) if len(o) else np.array([], int)
            n = np.diff(np.append(new, len(o)))
            own, hs = o[new], f[new]
            names = source.dictionary.to_pylist()
            for code in np.unique(codes):
                at = slice(*np.searchsorted(own, [code, code + 1]))
                by.setdefault(names[code] if code >= 0 else None, Summary(min_share)).add(hs[at], n[at], int((codes == code).sum()))
        for name, s in by.items():
            m = len(s.counts) + 1
            yield pa.RecordBatch.from_arrays([pa.array([name] * m, pa.string()), pa.array([*s.counts, None], pa.int64()), pa.array([*s.counts.values(), s.taken], pa.int64())], names=["source", "h", "n"])

    return docs.select("source", "hs").mapInArrow(run, "source string, h long, n long")


def merge(summaries: DataFrame) -> DataFrame:
    """Summaries of parts, days or partitions added up; the errors (rows with a null h) add up too."""
    return summaries.groupBy("source", "h").agg(F.sum("n").alias("n"))


def repeated_lines(df: DataFrame, key: str, source: Column, text: Column, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(places, confirmed) of the lines that stand in at least ``min_docs`` documents and ``min_share`` of all
    documents with a non-null text of their source. places: key, line_no; confirmed: source, h, docs, of_docs.

    A line counts once per row of ``df``, so repeated rows count. A null source is a source of its own. Null texts
    count nowhere; blank ones count as documents. An empty table gives empty results. Texts are read whole.

    Pass 1 makes heavy-hitter summaries in each partition and adds them up with their errors: no line that qualifies
    can be missing from them, unless the error of a source reaches its threshold; then all its lines are candidates. Pass 2 counts those candidates exactly. The candidates of a source are bounded by the lines per
    document over ``min_share``; they are broadcast if counted to a bounded size, else joined by a shuffle.
    """
    texts = df.where(text.isNotNull()).select(F.col(key).alias(key), source.alias("source"), line_hashes(text).alias("lines"))
    texts = written(texts)  # eight bytes a line; the texts themselves are read once
    docs = texts.select("source", F.array_distinct(F.array_compact("lines")).alias("hs"))
    sizes = texts.groupBy("source").agg(F.count("*").alias("of_docs"))
    floor = F.greatest(F.lit(min_docs), F.ceil(F.col("of_docs") * min_share - 1e-9))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    merged = materialize(merge(summarize(docs, min_share)))
    errors = merged.where("h is null").select("source", F.col("n").alias("error"))
    bounds = sizes.alias("s").join(errors.alias("e"), same("s", "e")).select("s.source", "of_docs", "error")
    candidates = materialize(
        merged.where("h is not null").alias("m").join(bounds.alias("b"), same("m", "b")).where(F.col("n") >= floor - F.col("error")).select("m.source", "h", "of_docs")
    )
    wanted = checked_broadcast(candidates)
    def counted(lines: DataFrame) -> DataFrame:
        return lines.groupBy("source", "h", "of_docs").agg(F.count("*").alias("docs")).where(F.col("docs") >= floor)

    each = docs.select("source", F.explode("hs").alias("h"))
    exact = counted(each.alias("d").join(wanted.alias("w"), same("d", "w") & (F.col("d.h") == F.col("w.h"))).select("w.source", "w.h", "w.of_docs"))
    # A summary can only miss a line that its error reaches; should that ever be so, every line of the source is counted.
    unsure = materialize(bounds.where(F.col("error") >= floor).select("source", "of_docs"))
    if unsure.count():
        exact = exact.unionByName(counted(each.alias("d").join(checked_broadcast(unsure).alias("u"), same("d", "u")).select("u.source", "d.h", "u.of_docs"))).distinct()
    confirmed = materialize(exact)
    found = checked_broadcast(confirmed.select("source", "h"))
    lines = texts.select(key, "source", F.posexplode("lines").alias("i", "h")).where("h is not null")
    places = lines.alias("l").join(found.alias("f"), same("l", "f") & (F.col("l.h") == F.col("f.h"))).select(key, (F.col("i") + 1).alias("line_no"))
    return places, confirmed


def without_repeated(df: DataFrame, key: str, source: Column, text: Column, confirmed: DataFrame) -> DataFrame:
    """``key`` and description: the text without the lines that are ``confirmed`` (source, h) for its source; the others keep
    their order and their own spelling.

    A text of which nothing is left is the empty string; null stays null. One narrow pass: the confirmed lines of each
    source are a set, whose size is bounded by the lines of a document over the least share, and all sets are broadcast
    if counted to a bounded size. With more sources than that the sets are cut into places of each document, met by
    ``key``, so that texts of one source do not meet in one task."""
    rows = df.select(F.col(key).alias(key), source.alias("_source"), text.alias("text"))
    sets = materialize(confirmed.groupBy("source").agg(F.collect_set("h").alias("drop")))
    hashes = line_hashes(F.col("text"))
    if fits_broadcast(sets):
        met = rows.alias("r").join(F.broadcast(sets).alias("s"), F.col("r._source").eqNullSafe(F.col("s.source")), "left").select(f"r.{key}", "r.text", "drop")
        pairs = F.arrays_zip(F.split("text", "\n").alias("line"), hashes.alias("h"))
        kept = F.transform(F.filter(pairs, lambda x: ~F.coalesce(F.array_contains("drop", x["h"]), F.lit(False))), lambda x: x["line"])
        return met.select(key, F.when(F.col("drop").isNull(), F.col("text")).when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("description"))
    lines = rows.where("text is not null").select(key, "_source", F.posexplode(hashes).alias("i", "h")).where("h is not null")
    hit = lines.alias("l").join(confirmed.alias("f"), F.col("l._source").eqNullSafe(F.col("f.source")) & (F.col("l.h") == F.col("f.h"))).groupBy(key).agg(F.collect_set("i").alias("drop"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("drop", i))
    return rows.join(hit, key, "left").select(key, F.when(F.col("drop").isNull(), F.col("text")).when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("description"))
