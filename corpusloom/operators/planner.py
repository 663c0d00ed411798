"""Sequential planners: state runs through one source in order, so a source is the unit of parallel work (applyInPandas)."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators.intervals import binned_range_join

Boundary = tuple[float, bool, bool]  # position, structural, safe to close outside a quotation


def plan_clips(boundaries: list[Boundary], begin: float, targets: Iterator[float], most: float) -> tuple[list[tuple[float, float, bool]], int, int]:
    """I8: ((from, to, structural) of each clip, deferred, forced). A clip closes at a structural boundary, or where the
    next one would take it over ``most``, or once it has reached its target outside a quotation. What follows the last
    boundary is not emitted."""
    clips, deferred, forced = [], 0, 0
    target = next(targets)
    for (pos, struct, safe), after in zip(boundaries, [*(b[0] for b in boundaries[1:]), float("inf")]):
        must = struct or after - begin > most
        reached = pos - begin >= target
        forced += must and not struct and not safe
        deferred += reached and not must and not safe
        if must or (reached and safe):
            clips.append((begin, pos, struct))
            begin, target = pos, next(targets)
    return clips, deferred, forced


def merge_spans(spans: list[tuple[float, float]], target: float, most: float) -> list[tuple[float, float]]:
    """Neighbours joined while the span is short of ``target`` and stays within ``most``."""
    out: list[list[float]] = []
    for a, b in spans:
        if out and out[-1][1] - out[-1][0] < target and b - out[-1][0] <= most:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def split_at_gaps(span: tuple[float, float], gaps: list[tuple[float, float, float]], most: float) -> list[tuple[float, float]]:
    """The span cut at the quietest point of its longest inner gap (begin, end, quietest point) until every part is at
    most ``most`` long; the first of equal gaps is taken, and a part without a gap, or whose point lies outside it, stays."""
    todo, out = [span], []
    while todo:
        a, b = todo.pop()
        inner = [x for x in gaps if a < x[0] and x[1] < b] if b - a > most else []
        cut = max(inner, key=lambda x: x[1] - x[0])[2] if inner else a
        if a < cut < b:
            todo += [(cut, b), (a, cut)]
        else:
            out.append((a, b))
    return out


def merged_spans(spans: DataFrame, by: str, target: float, most: float) -> DataFrame:
    """I9 for each source of (by, a, b): by, span (from 0), a, b."""

    def run(key, pdf):
        import pandas as pd

        return pd.DataFrame([(key, i, *x) for i, x in enumerate(merge_spans(list(zip(pdf["a"], pdf["b"])), target, most))], columns=[by, "span", "a", "b"])

    return grouped(spans.select(by, "a", "b"), by, ["a", "b"], run, f"{by} {dict(spans.dtypes)[by]}, span int, a double, b double")


def split_spans(spans: DataFrame, gaps: DataFrame, by: str, most: float) -> DataFrame:
    """I10 for each source of (by, a, b) and its gaps (by, g0, g1 and, if known, quiet: the quietest point, else the middle is
    taken): by, part (from 0), a, b. A span longer than ``most`` meets only the gaps of its source."""
    quiet = F.coalesce("quiet", (F.col("g0") + F.col("g1")) / 2) if "quiet" in gaps.columns else (F.col("g0") + F.col("g1")) / 2
    g = gaps.select(by, "g0", "g1", quiet.alias("quiet"))

    def run(key, left, right):
        import pandas as pd

        inner = [tuple(x) for x in right.sort_values(["g0", "g1"])[["g0", "g1", "quiet"]].itertuples(index=False)]
        begins = [x[0] for x in inner]
        parts = []
        for a, b in left.sort_values(["a", "b"])[["a", "b"]].itertuples(index=False):
            parts += split_at_gaps((a, b), inner[bisect_right(begins, a) : bisect_left(begins, b)], most)
        return pd.DataFrame([(key[0], i, *x) for i, x in enumerate(parts)], columns=[by, "part", "a", "b"])

    return spans.select(by, "a", "b").groupBy(by).cogroup(g.groupBy(by)).applyInPandas(run, f"{by} {dict(spans.dtypes)[by]}, part int, a double, b double")


def probe_cues(starts: list[float], step: float, reach: float = 240.0) -> list[int]:
    """For each target step, 2 * step, ... up to the last start the nearest cue (of ordered ones) within ``reach`` not yet used."""
    used: set[int] = set()
    picked: list[int] = []
    target = step
    while starts and target <= starts[-1]:
        lo, hi = bisect_left(starts, target - reach), bisect_right(starts, target + reach)
        free = [(abs(starts[i] - target), i) for i in range(lo, hi) if i not in used]
        if free:
            used.add(i := min(free)[1])
            picked.append(i)
        target += step
    return picked


def probes(cues: DataFrame, by: str, start: str, step: float, reach: float = 240.0) -> DataFrame:
    """I14 for each source: the rows of ``cues`` that are probed, with probe (from 0), in the order of their targets."""

    def run(key, pdf):
        picked = probe_cues(pdf[start].tolist(), step, reach)
        return pdf.iloc[picked].assign(probe=range(len(picked))).astype({"probe": "int32"})

    from pyspark.sql import types as T

    schema = T.StructType([*cues.schema.fields, T.StructField("probe", T.IntegerType())])
    return grouped(cues.where(F.col(start).isNotNull()), by, start, run, schema)


def opening_offsets(cues: DataFrame, heard: DataFrame, by: str, cue: str, reach: float, window: int = 12, first: int = 6) -> DataFrame:
    """``by``, ``cue`` and offset, the distance in time from the cue to where its opening words are heard.

    cues: by, cue, start, tokens (array); heard: by, pos, token, at. A place counts if it has the first token, and of the
    first ``first`` ones at least max(2, all but one) in their order within ``window`` words; the place nearest in time
    wins, at most ``reach`` seconds away. Cues without one have no row. An equi join on source, first token and time."""
    w = Window.partitionBy(by).orderBy("pos").rowsBetween(0, window - 1)
    h = heard.select(by, F.col("token").alias("_t"), F.col("at").alias("_at"), F.collect_list("token").over(w).alias("_next"))  # ``window`` items
    c = cues.select(by, cue, F.col("start").alias("_start"), F.slice("tokens", 1, first).alias("_want")).where(F.size("_want") > 0).withColumn("_t", F.col("_want")[0])
    met = binned_range_join(h, c, [by, "_t"], F.col("_at"), F.col("_start") - reach, F.col("_start") + reach, 2 * reach)
    hits = F.aggregate("_next", F.lit(0), lambda n, t: F.when(t == F.get("_want", n), n + 1).otherwise(n))
    good = met.where(hits >= F.greatest(F.lit(2), F.size("_want") - 1))
    offset = F.col("_at") - F.col("_start")
    return good.groupBy(by, cue).agg(F.min_by(offset, F.struct(F.abs(offset), offset)).alias("offset"))


def cap_parts(sizes: list[float], cap: float) -> list[int]:
    """I12, cap mode: the part of each item when a part is closed before it would exceed ``cap``."""
    out, part, held = [], 0, 0.0
    for s in sizes:
        if held and held + s > cap:
            part, held = part + 1, 0.0
        held += s
        out.append(part)
    return out


def grouped(df: DataFrame, by: str, order: str | list[str], run: Callable, schema: str | StructType) -> DataFrame:
    """Rows of each ``by`` in order through ``run(key, pandas frame) -> pandas frame``. The largest source bounds memory."""

    def apply(key, pdf):
        return run(key[0], pdf.sort_values(order, kind="stable"))

    return df.groupBy(by).applyInPandas(apply, schema)


def capped_parts(df: DataFrame, by: str, order: str, size: str, cap: float) -> DataFrame:
    """I12, cap mode, for each source: ``df`` with part. A null size counts 0."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType())])
    return grouped(df, by, order, lambda key, pdf: pdf.assign(part=cap_parts(pdf[size].fillna(0).tolist(), cap)).astype({"part": "int32"}), schema)


def planned(boundaries: DataFrame, by: str, target: float, most: float) -> DataFrame:
    """``plan_clips`` for each source of (by, pos, struct, quote_safe) with one target: by, clip, a, b, struct_end."""

    def run(key, pdf):
        import itertools

        import pandas as pd

        rows = list(zip(pdf["pos"], pdf["struct"], pdf["quote_safe"]))
        clips, *_ = plan_clips(rows[1:], rows[0][0], itertools.repeat(target), most)
        return pd.DataFrame([(key, i, *c) for i, c in enumerate(clips)], columns=[by, "clip", "a", "b", "struct_end"])

    kind = dict(boundaries.dtypes)[by]
    return grouped(boundaries, by, "pos", run, f"{by} {kind}, clip int, a double, b double, struct_end boolean")
