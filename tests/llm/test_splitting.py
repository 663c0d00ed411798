import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.splitting import PIECES, boundaries, split_clips, split_item, split_text  # noqa: F401

TEXT = "First sentence here. Second one, with a comma; and more! 日本語の文。次の文。 And a last one without end"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ,.;\n!é日。", max_size=400), st.integers(1, 60), st.integers(0, 40))
def test_pieces_cover_the_text_within_the_limit(text, most, overlap):
    parts = split_text(text, most, overlap)
    assert parts[0][0] == 0 and parts[-1][2] == len(text)
    for (s0, a0, b0), (s1, a1, b1) in zip(parts, parts[1:]):
        assert b0 == a1 and 0 <= s1 <= a1 and a1 - s1 <= overlap
        if overlap < most:  # in full, less only to begin at a natural place
            assert a1 - s1 == min(overlap, a1) or s1 in boundaries(text)[1]
        else:
            assert a1 - s1 <= most // 2
    assert all(b - s <= most for s, _, b in parts)
    assert "".join(text[a:b] for _, a, b in parts) == text


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab .", max_size=120)), st.one_of(st.none(), st.floats(0, 500)), st.integers(5, 50), st.floats(0.5, 30), st.integers(0, 20))
def test_items(text, seconds, chars, most, overlap):
    parts = split_item(text, seconds, chars, most, overlap)
    assert parts
    if seconds is not None:
        assert math.isclose(sum(p[4] for p in parts), seconds, abs_tol=1e-6)
        assert all(p[4] <= most + 1e-6 for p in parts)
    if text:
        assert "".join(text[p[3] : p[2]] for p in parts) == text
        assert all(len(p[0]) <= max(chars, 1) for p in parts)


def test_natural_places_first():
    text = "One two three four. Five six seven eight. Nine ten eleven twelve."
    assert [text[a:b].strip() for _, a, b in split_text(text, 30, 0)] == ["One two three four.", "Five six seven eight.", "Nine ten eleven twelve."]


def test_overlap_begins_at_a_place():
    parts = split_text(TEXT * 4, 60, 20)
    full = TEXT * 4
    assert all(s == a or not full[s - 1].isalnum() or not full[s].isalnum() or a - s == 20 for s, a, _ in parts)


@pytest.fixture
def profiles(spark):
    return spark.createDataFrame([("p", 10.0, 20, 5), ("n", None, None, None)], "profile string, max_clip_seconds double, max_chars int, overlap_chars int")


def test_limits_nulls_and_repeats(spark, profiles):
    rows = [(1, "x" * 20, 10.0, "p"), (2, "x" * 21, 1.0, "p"), (3, "short", 25.0, "p"), (4, None, 25.0, "p"), (5, "", 25.0, "p"), (6, "x" * 99, None, "p"), (7, "x" * 99, 99.0, "n"), (8, "x" * 99, 99.0, None), (2, "x" * 21, 1.0, "p"), (9, None, None, "p")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "clip_id long, text string, seconds double, profile string, max_chars string")
    got = split_clips(df, profiles).collect()
    by = {}
    for r in got:
        by.setdefault(r.clip_id, []).append(r)
    assert set(by) == {2, 3, 4, 5, 6}
    assert len(by[2]) == 4 and len(by[4]) == 3 and {r.text for r in by[4]} == {None} and {r.text for r in by[5]} == {""}
    assert all(r.seconds is None for r in by[6]) and [r.piece for r in sorted(by[3], key=lambda r: r.piece)] == list(range(len(by[3])))
    assert split_clips(df.limit(0), profiles).count() == 0


def test_an_overlap_of_half_the_limit_and_more_is_kept():
    text = "x" * 200
    for overlap in (10, 11, 15, 19):
        parts = split_text(text, 20, overlap)
        assert all(a - s == overlap for s, a, _ in parts[1:]) and all(b - s <= 20 for s, _, b in parts)
