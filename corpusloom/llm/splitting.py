"""Splitting oversized items at natural boundaries, by recursive bisection."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places to cut, strongest first; a cut lies at the end of a match.
BOUNDARIES = (
    (6, re.compile(r"\n\s*\n\s*")),
    (5, re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？]+[”」』）]*\s*|\n\s*")),
    (4, re.compile(r"[;:]\s+|\s+[–—]\s+|[；：]")),
    (3, re.compile(r",\s+|[、，]")),
    (1, re.compile(r"\s+")),
)
#: A cut may lie this share of a segment's length away from its midpoint, for the strongest kinds of boundary.
REACH = 0.3
PIECES = "clip_id long, piece int, pieces int, text string, start_char int, end_char int, core_start int, seconds double"


def boundaries(text: str) -> tuple[list[int], dict[int, int]]:
    """Sorted positions at which a piece may begin, and the strength of each."""
    strength: dict[int, int] = {}
    for k, pattern in reversed(BOUNDARIES):
        for m in pattern.finditer(text):
            strength[m.end()] = k
    strength.pop(0, None)
    strength.pop(len(text), None)
    return sorted(strength), strength


def bisect_cuts(text: str, room: int, most: int, known: tuple[list[int], dict[int, int]] | None = None) -> list[int]:
    """Cut positions such that the first part is at most ``most`` characters long and each later one at most ``room``.

    A segment that is too long is cut at the strongest boundary near its midpoint (the nearest of the strongest
    within REACH of it; else the nearest of any kind; without one, at the midpoint), then both halves again."""
    places, strength = known or boundaries(text)
    cuts: list[int] = []
    todo = [(0, len(text))]
    while todo:
        a, b = todo.pop()
        if b - a <= (most if a == 0 else room):
            continue
        mid = (a + b) // 2
        reach = max(1, int((b - a) * REACH))
        near = places[bisect_left(places, max(a + 1, mid - reach)) : bisect_right(places, min(b - 1, mid + reach))]
        if near:
            cut = min(near, key=lambda p: (-strength[p], abs(p - mid), p))
        else:
            inner = places[bisect_left(places, a + 1) : bisect_right(places, b - 1)]
            cut = min(inner, key=lambda p: (abs(p - mid), p)) if inner else mid
        cuts.append(cut)
        todo += [(a, cut), (cut, b)]
    return sorted(cuts)


def merge_cuts(n: int, cuts: list[int], room: int, most: int) -> list[int]:
    """Without the cuts whose two sides fit together after all."""
    edges, kept, start = [*cuts, n], [], 0
    for here, after in zip(edges, edges[1:]):
        if after - start > (most if start == 0 else room):
            kept.append(here)
            start = here
    return kept


def split_text(text: str, max_chars: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, core start, end) of each piece: at most ``max_chars`` long; start to core start is the overlap with the
    piece before: ``overlap`` characters, less only to begin at a boundary.

    The overlap is kept in full wherever it fits: wherever it is shorter than a piece. One that is not leaves no room
    for anything new in a piece; then half of the piece is overlap."""
    overlap = max(0, overlap if overlap < max_chars else max_chars // 2)
    room = max_chars - overlap
    places, strength = boundaries(text)
    cuts = merge_cuts(len(text), bisect_cuts(text, room, max_chars, (places, strength)), room, max_chars)
    edges, out = [0, *cuts, len(text)], []
    for a, b in zip(edges, edges[1:]):
        start = a
        if a and overlap:
            first = max(0, a - overlap)
            i = bisect_left(places, first) if first else 0
            start = first if not first or i == len(places) or places[i] >= a else places[i]
        out.append((start, a, b))
    return out


def split_item(text: str | None, seconds: float | None, max_chars: int | None, max_seconds: float | None, overlap: int | None) -> list[tuple]:
    """(text, start_char, end_char, core_start, seconds) of each piece of one item.

    Seconds are shared out by characters of the core, so that they add up to the item's; a piece is kept so short
    that its share with the overlap is within the limit too. An item whose text is null or empty, or of fewer
    characters than it needs pieces, is cut into equal slices of time, the text (if any) as evenly as it goes."""
    n = len(text or "")
    long = seconds is not None and max_seconds is not None and max_seconds > 0 and seconds > max_seconds
    slices = -int(-(seconds / max_seconds) // 1) if long else 1
    limit = max_chars if max_chars is not None and max_chars > 0 and n > max_chars else max(n, 1)
    if long and n:
        limit = min(limit, int(n * max_seconds / seconds))
    if n == 0 or limit < 1:
        edges = [n * i // slices for i in range(slices + 1)]
        return [(text and text[a:b], a, b, a, None if seconds is None else seconds / slices) for a, b in zip(edges, edges[1:])]
    parts = split_text(text, limit, overlap or 0)
    return [(text[s:b], s, b, a, None if seconds is None else seconds * (b - a) / n) for s, a, b in parts]


def oversized(clips: DataFrame, profiles: DataFrame) -> DataFrame:
    """The rows of ``clips`` over a limit of their profile, with those limits. A null is not above, equal is not above."""
    limits = profiles.select("profile", "max_clip_seconds", "max_chars", "overlap_chars").where("profile is not null")
    rows = clips.select("clip_id", "text", "seconds", "profile").join(limits, "profile")
    return rows.where((F.col("seconds") > F.col("max_clip_seconds")) | (F.char_length("text") > F.col("max_chars")))


def split_clips(clips: DataFrame, profiles: DataFrame) -> DataFrame:
    """Ordered pieces of the oversized rows of ``clips``: clip_id, piece (from 0), pieces, text, start_char, end_char,
    core_start (where the overlap with the piece before ends), seconds.

    Rows within their limits, with an unknown profile or with nulls in all that is measured give no pieces. Each row
    is split by itself, repeated rows too; no shuffle but the join with the few profiles."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for c, t, s, ms, mc, o in zip(pdf["clip_id"], pdf["text"], pdf["seconds"], pdf["max_clip_seconds"], pdf["max_chars"], pdf["overlap_chars"]):
                none = lambda x: None if pd.isna(x) else x
                parts = split_item(t, none(s), None if pd.isna(mc) else int(mc), none(ms), None if pd.isna(o) else int(o))
                rows += [(c, k, len(parts), *p) for k, p in enumerate(parts)]
            yield pd.DataFrame(rows, columns=["clip_id", "piece", "pieces", "text", "start_char", "end_char", "core_start", "seconds"])

    return oversized(clips, profiles).select("clip_id", "text", "seconds", "max_clip_seconds", "max_chars", "overlap_chars").mapInPandas(run, PIECES)
