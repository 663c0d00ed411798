"""Interval and sequence operators: threshold runs, union, complement, containment, nearest gap, sized parts.

Intervals are rows with a source, a start and an end of one numeric unit. Two containments are kept apart: ``mid_in``
(half-open, by the midpoint) and ``overlaps`` (strict). Windows run per source; sources bound the size of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mid_in(start: Column, end: Column, a: Column, b: Column) -> Column:
    """a <= midpoint < b."""
    return (a <= (start + end) / 2) & ((start + end) / 2 < b)


def overlaps(start: Column, end: Column, a: Column, b: Column) -> Column:
    """The two share more than a point."""
    return (start < b) & (end > a)


def threshold_runs(df: DataFrame, by: list[str], order: list[str], pred: Column, at_least: int = 1, edges: bool = True) -> DataFrame:
    """Runs of consecutive rows for which ``pred`` holds (null is no), of ``at_least`` rows.

    Returns by, run (from 0 in each group), first_row, last_row (row numbers from 0), n. ``edges=False`` leaves out runs
    that touch the group's first or last row. ``order`` must be total."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = df.select(*by, *order, F.coalesce(pred, F.lit(False)).alias("_in"), (F.row_number().over(w) - 1).alias("_i"))
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    inside = rows.where("_in").withColumn("_island", F.col("_i") - F.row_number().over(w))
    runs = inside.groupBy(*by, "_island").agg(F.min("_i").alias("first_row"), F.max("_i").alias("last_row"), F.count("*").alias("n"), F.max("_n").alias("_n"))
    runs = runs.where(F.col("n") >= at_least)
    if not edges:
        runs = runs.where((F.col("first_row") > 0) & (F.col("last_row") < F.col("_n") - 1))
    return runs.select(*by, (F.row_number().over(Window.partitionBy(*by).orderBy("first_row")) - 1).alias("run"), "first_row", "last_row", "n")


def union(df: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or touching intervals as one. Nulls and intervals that end before they start are left out."""
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.select(*by, start, end).where(F.col(start) <= F.col(end))
    flagged = rows.withColumn("_new", F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0))
    grouped = flagged.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*by, "_g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged")).drop("_g")


def complement(df: DataFrame, by: list[str], total: DataFrame, start: str = "start", end: str = "end", at_least: float = 0.0) -> DataFrame:
    """What of [lo, hi] of each row of ``total`` (by, lo, hi) no interval covers, of more than ``at_least``.

    A group without intervals gives all of [lo, hi]; groups missing from ``total`` give nothing."""
    merged = union(df, by, start, end).select(*by, F.col(start).alias("_s"), F.col(end).alias("_e"))
    ends = total.select(*by, F.col("lo").alias("_s"), F.col("lo").alias("_e")).unionByName(total.select(*by, F.col("hi").alias("_s"), F.col("hi").alias("_e")))
    inside = merged.join(total, by).select(*by, F.greatest("_s", "lo").alias("_s"), F.least("_e", "hi").alias("_e")).where("_s <= _e")
    w = Window.partitionBy(*by).orderBy("_s", "_e")
    reached = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return inside.unionByName(ends).select(*by, reached.alias(start), F.col("_s").alias(end)).where(F.col(end) - F.col(start) > at_least)


def binned_range_join(left: DataFrame, right: DataFrame, by: list[str], point: Column, lo: Column, hi: Column, width: float, how: str = "inner") -> DataFrame:
    """Points of ``left`` in [lo, hi] of ``right``: an equi join on (by, bin) with the exact test after it.

    ``right`` is repeated once for each bin of ``width`` it touches, so choose ``width`` near the usual length of an
    interval: no nested loop, and a hot source is spread over its bins. Columns of ``right`` but ``by`` must not
    clash with those of ``left``. how: inner, left, left_semi, left_anti."""
    a = left.withColumn("_p", point).withColumn("_bin", F.floor(F.col("_p") / width))
    b = right.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi")
    b = b.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width))))
    keys = ["_bin", *by]
    on = (F.col("a._p") >= F.col("b._lo")) & (F.col("a._p") <= F.col("b._hi"))
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    out = a.alias("a").join(b.alias("b"), on, how)
    keep = [F.col(f"a.{c}") for c in left.columns]
    if how not in ("left_semi", "left_anti"):
        keep += [F.col(f"b.{c}") for c in right.columns if c not in by]
    return out.select(*keep)


def nearest(left: DataFrame, right: DataFrame, by: list[str], left_id: str, point: Column, lo: Column, hi: Column, width: float, tie: str, within: float) -> DataFrame:
    """For each row of ``left`` the row of ``right`` whose [lo, hi] lies nearest to ``point``, at most ``within``
    away (distance 0 inside); ties go to the least ``tie``. Rows without one are left out. Adds distance."""
    r = right.withColumn("_l", lo).withColumn("_h", hi)
    pairs = binned_range_join(left.withColumn("_pt", point), r, by, F.col("_pt"), F.col("_l") - within, F.col("_h") + within, width)
    distance = F.greatest(F.lit(0.0), F.col("_l") - F.col("_pt"), F.col("_pt") - F.col("_h"))
    best = F.row_number().over(Window.partitionBy(left_id).orderBy("distance", tie))
    return pairs.withColumn("distance", distance).withColumn("_rn", best).where("_rn = 1").drop("_rn", "_pt", "_l", "_h")


def without_excluded(df: DataFrame, excluded: DataFrame, by: list[str], width: float, start: str = "start", end: str = "end") -> DataFrame:
    """Rows that overlap no excluded interval (columns by, start, end), through an equi join on bins.

    A row over several bins goes if any of them meets one. Rows are told apart by a number they are written with."""
    from corpusloom.session import materialize

    a = materialize(df.withColumn("_row", F.monotonically_increasing_id()))  # read twice: the numbers must be the same
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    rows = a.where(F.col(start) <= F.col(end)).select("_row", *by, F.col(start).alias("_s"), F.col(end).alias("_e"), bins(start, end).alias("_bin"))
    bad = excluded.select(*by, F.col(start).alias("_a"), F.col(end).alias("_b")).where("_a <= _b").withColumn("_bin", bins("_a", "_b"))
    hit = rows.join(bad, [*by, "_bin"]).where(overlaps(F.col("_s"), F.col("_e"), F.col("_a"), F.col("_b"))).select("_row").distinct()
    return a.join(hit, "_row", "left_anti").drop("_row")


def texts_by_midpoint(units: DataFrame, spans: DataFrame, by: list[str], order: str, width: float) -> DataFrame:
    """The texts of ``units`` (by, start, end, text, order) joined in order for each of ``spans`` (by, span_id, a, b).

    A unit belongs to the spans its midpoint lies in (half-open). Spans without units are left out."""
    mid = (F.col("start") + F.col("end")) / 2
    pairs = binned_range_join(units.withColumn("_m", mid), spans, by, F.col("_m"), F.col("a"), F.col("b"), width).where(F.col("_m") < F.col("b"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col("text")))), lambda x: x["text"])
    return pairs.groupBy(*by, "span_id").agg(F.trim(F.regexp_replace(F.array_join(ordered, " "), r"\s+", " ")).alias("text"), F.count("*").alias("units"))


def snap_boundaries(cues: DataFrame, gaps: DataFrame, by: str, window: float, struct_gap: float = 2.5, width: float = 30.0) -> DataFrame:
    """The end of each sentence-final cue (or one before a heading) snapped to the nearest gap within ``window``.

    cues: by, cue_idx, end, final, heading, open_after. gaps: by, g0, g1. Cues that snap to one gap become one
    boundary: struct (a gap of ``struct_gap`` or beside a heading) if any cue says so; quote_safe by the last cue, or
    struct so far. Returns by, pos, gstart, struct, quote_safe."""
    nxt = F.coalesce(F.lead("heading").over(Window.partitionBy(by).orderBy("cue_idx")), F.lit(False))
    c = cues.withColumn("_next", nxt).where(F.col("final") | F.col("_next")).select(by, "cue_idx", F.col("end").alias("_end"), (F.col("heading") | F.col("_next")).alias("_head"), "open_after")
    c = c.withColumn("_key", F.struct(F.col(by), F.col("cue_idx")))
    hit = nearest(c, gaps, [by], "_key", F.col("_end"), F.col("g0"), F.col("g1"), width, "g0", window)
    struct = (F.col("g1") - F.col("g0") >= struct_gap) | F.col("_head")
    return hit.withColumn("_struct", struct).groupBy(by, F.col("g1").alias("pos"), F.col("g0").alias("gstart")).agg(
        F.bool_or("_struct").alias("struct"), (F.bool_or("_struct") | F.max_by(~F.col("open_after"), "cue_idx")).alias("quote_safe")
    )


def sized_parts(df: DataFrame, by: list[str], order: list[str], size: str, parts: int) -> DataFrame:
    """Each row's part of ``parts`` by cumulative size: least(parts - 1, floor(before * parts / total)).

    Exact for items smaller than total / parts. Without ``by`` the whole table is one sequence: sizes are added up
    per range partition first, so no task holds all rows."""
    if not by:
        return _global_parts(df, order, size, parts)
    rows = grouped_running(df, by, order, size)
    return rows.withColumn("part", _part(parts)).drop("before", "row", "total", "rows")


def _part(parts: int) -> Column:
    """All rows are part 0 where nothing has a size."""
    return F.when(F.col("total") > 0, F.least(F.lit(parts - 1), F.floor(F.col("before") * parts / F.col("total"))).cast("int")).otherwise(0)


def ranged(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """``df`` in one global order, cut into ranges: adds _p (the range), _before (the sum of ``value`` in the rows of the
    range before this one) and _row (their number). Written once; a null value counts 0.

    One range-partitioned sort and one pass over each sorted range; rows travel once."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from corpusloom.session import materialize

    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    at = df.columns.index(value)
    names = [*df.columns, "_p", "_before", "_row"]

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        part, so_far, row = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            v = batch.column(at).cast(pa.int64() if whole else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.cumsum(np.concatenate((np.array([so_far], v.dtype), v)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(upto[:-1]), pa.array(np.arange(row, row + n))], names=names)
            so_far, row = upto[-1], row + n

    schema = T.StructType([*df.schema.fields, T.StructField("_p", T.IntegerType()), T.StructField("_before", T.LongType() if whole else T.DoubleType()), T.StructField("_row", T.LongType())])
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))


def global_running(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """``df`` with before (the sum of ``value`` in all rows before), row (from 0), total and total_rows, over one global order.

    A range-partitioned sort; sums per range are added up in a window over as many rows as there are partitions."""
    from corpusloom.session import checked_broadcast

    placed = ranged(df, order, value)
    sums = placed.groupBy("_p").agg(F.sum(value).alias("_s"), F.count("*").alias("_c"))
    w = Window.partitionBy(F.lit(0))
    upto = w.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    offsets = sums.select(
        "_p", zero(F.sum("_s").over(upto)).alias("_off"), F.sum("_s").over(w).alias("total"), zero(F.sum("_c").over(upto)).alias("_rows"), F.sum("_c").over(w).alias("total_rows")
    )  # one row per partition
    rows = placed.join(checked_broadcast(offsets), "_p")
    kept = [F.col(c) for c in df.columns]
    return rows.select(*kept, "total", "total_rows", (F.col("_before") + F.col("_off")).alias("before"), (F.col("_row") + F.col("_rows")).alias("row"))


def grouped_running(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """``df`` with before, total, row (from 0) and rows of each group of ``by``, in one total ``order``.

    One range-partitioned sort over (by, order): a group of any size is spread over as many partitions as it needs. What
    each range holds of a group gives the group's offset there. A null in ``by`` is a group of its own."""
    from corpusloom.session import checked_broadcast

    placed = ranged(df, [*by, *order], value)
    # A row per range and group: as ranges cut a group only at their ends, groups + ranges rows.
    held = placed.groupBy("_p", *by).agg(F.sum(value).alias("_s"), F.count("*").alias("_c"), F.min("_row").alias("_r"), F.min_by("_before", "_row").alias("_b"))
    w = Window.partitionBy(*by)
    upto = w.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    offsets = held.select(
        "_p", *by, (zero(F.sum("_s").over(upto)) - F.col("_b")).alias("_off"), (zero(F.sum("_c").over(upto)) - F.col("_r")).alias("_first"), F.sum("_s").over(w).alias("total"), F.sum("_c").over(w).alias("rows")
    )
    same = F.col("x._p") == F.col("f._p")
    for k in by:
        same = same & F.col(f"x.{k}").eqNullSafe(F.col(f"f.{k}"))
    own = placed.alias("x").join(checked_broadcast(offsets).alias("f"), same)
    kept = [F.col(f"x.{c}") for c in df.columns]
    return own.select(*kept, (F.col("_before") + F.col("_off")).alias("before"), (F.col("_row") + F.col("_first")).alias("row"), "total", "rows")


def _global_parts(df: DataFrame, order: list[str], size: str, parts: int) -> DataFrame:
    rows = global_running(df, order, size)
    part = _part(parts)
    return rows.withColumn("part", part).drop("before", "total", "row", "total_rows")


def join_times(df: DataFrame, by: list[str], order: list[str], seconds: str) -> DataFrame:
    """Where each part begins when all are played one after the other."""
    return grouped_running(df, by, order, seconds).withColumnRenamed("before", "begins").drop("row", "total", "rows")


def quote_open_after(df: DataFrame, by: list[str], order: list[str], marks: Column) -> DataFrame:
    """Is a quotation open after this row: odd running count of quote marks."""
    rows = grouped_running(df.withColumn("_marks", F.coalesce(marks, F.lit(0)).cast("long")), by, order, "_marks")
    return rows.withColumn("open_after", (F.col("before") + F.col("_marks")) % 2 == 1).drop("_marks", "before", "row", "total", "rows")


def capped_pauses(gaps: DataFrame, between: Column, cap: float = 2.0, structural: float = 2.5, structural_cap: float = 0.4, mid_cap: float = 0.3) -> DataFrame:
    """I16: the length each pause keeps: structural ones ``structural_cap``, natural ones between sentences at most
    ``cap``, those inside a sentence ``mid_cap``; adds kept and cut (seconds taken out)."""
    long = F.col("g1") - F.col("g0")
    kept = F.when(long >= structural, F.lit(structural_cap)).when(between, F.least(long, F.lit(cap))).otherwise(F.least(long, F.lit(mid_cap)))
    return gaps.withColumn("kept", kept).withColumn("cut", long - kept)
