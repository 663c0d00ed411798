import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import overlap
from corpusloom.llm.overlap import edit_distance, found, near, near_copies, report, words_of

SCHEMA = "clip_id long, text string, speaker string, split string, id int, train int"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=90), st.lists(st.sampled_from("abcd"), max_size=90), st.integers(0, 90))
def test_distance(a, b, most):
    d = plain_distance(a, b)
    got = edit_distance(a, b, most)
    assert got == d if d <= most else got > most


def test_words():
    assert words_of("“Don’t STOP, the ｆｉｎｅ fi​ne dіe café!”") == ["don't", "stop", "the", "fine", "fine", "die", "café"]
    assert words_of("'so' it's a_b 1st") == ["so", "it's", "a", "b", "1st"]
    assert words_of(None) == words_of("") == []


@pytest.mark.parametrize("per", [5, 4])
def test_spans_are_disjoint_and_inside(per):
    r = random.Random(5)
    n = np.array([r.randint(8, 90) for _ in range(300)] + [8, 9, 10, 11, 15, 499, 507, 508, 509, 700, 1000, 1003, 1007, 1008, 1012, 30_000])
    x = np.array([r.randint(0, 40) for _ in range(int(n.sum()))], np.uint32)
    start = np.concatenate(([0], np.cumsum(n)[:-1]))
    place, length, k = overlap.choose_spans(overlap.span_costs(x), n, start, per)
    cut = np.concatenate(([0], np.cumsum(k)))
    for m, a, b in zip(n, cut[:-1], cut[1:]):
        assert b - a == m // per + 1
        p, w = place[a:b], length[a:b]
        assert (p >= 0).all() and (p[-1] + w[-1] <= m) and set(w) <= set(overlap.SPANS) and (p[1:] >= (p + w)[:-1]).all()


def test_blocks_come_back():
    r = np.random.default_rng(3)
    cols = [np.sort(r.integers(0, 1 << 62, 1000)), r.integers(-(1 << 62), 1 << 62, 1000), *(r.integers(0, 1 << 31, 1000) for _ in range(3))]
    assert all((a == b).all() for a, b in zip(cols, overlap._unpack(overlap._pack(*cols))))


def test_entries_grow_with_the_words_only():
    """Entries a word, of suffixes and seekers, at two sizes ten times apart."""
    r = np.random.default_rng(4)
    per_word = []
    for texts in (300, 3000):
        n = r.integers(8, 90, texts)
        x = r.zipf(1.3, int(n.sum())).astype(np.uint32) & 0xFFFFFF
        text, *_ = overlap.seekers(x, n, np.concatenate(([0], np.cumsum(n)[:-1])))
        per_word.append(len(text) / n.sum())
        assert len(text) <= (n // 5 + 1 + n // 4 + 1).sum()
    assert abs(per_word[0] - per_word[1]) < 0.02 and per_word[1] < 0.55


def corpus(seed=1, n=260):
    """Texts with boilerplate beginnings, near-copies up to and beyond the bound, copies of copies, short ones and nulls."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows, base = [], []
    for i in range(n):
        size = r.choice([5, 8, 9, 10, 11, 12, 15, 16, 20, 34, 50, 120])
        if base and r.random() < 0.6:
            words = list(r.choice(base))
            for _ in range(r.randint(0, max(1, len(words) // 4))):
                at, how = r.randrange(len(words) + 1), r.random()
                if how < 0.4 and at < len(words):
                    words[at] = r.choice(vocab)
                elif how < 0.7:
                    words.insert(at, r.choice(vocab))
                elif at < len(words):
                    del words[at]
        else:
            words = [r.choice(vocab) for _ in range(size)]
            if r.random() < 0.3:
                words = "welcome back to the evening reading friends and settle in".split() + words
            base.append(words)
        text = " ".join(w.upper() if r.random() < 0.1 else w for w in words) + r.choice(["", ".", "!"])
        rows.append((i, text, r.choice(["a", "b", None]), r.choice(["train", "train", "eval", "holdout"]), 0, 0))
    rows += [(n, None, "a", "eval", 0, 0), (n + 1, "", "a", "train", 0, 0), (n + 2, rows[0][1], "a", None, 0, 0)]
    same = "one text that stands in a third of all rows of the table"
    rows += [(n + 10 + i, same, "c", "train" if i % 4 else "eval", 0, 0) for i in range(60)]
    return rows


def brute(rows):
    words = [(i, split, words_of(t)) for i, t, _, split, *_ in rows if split is not None]
    words = [w for w in words if len(w[2]) >= 8]
    return {(min(i, j), max(i, j)) for i, s, a in words if s != "train" for j, t, b in words if t == "train" and near(a, b)}


def test_no_link_is_lost(spark, monkeypatch):
    for seed, together, most, sample in ((1, 500, 1_000_000, 400), (2, 2000, 300, 0)):
        monkeypatch.setattr(overlap, "TOGETHER", together)
        monkeypatch.setattr(overlap, "SAMPLE", sample)  # 0: no text of the sample
        monkeypatch.setattr(overlap, "RANGE", most)  # many ranges, with several parts each
        monkeypatch.setattr(overlap, "SEEKERS", most)
        rows = corpus(seed)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = [(r.clip_id_a, r.clip_id_b) for r in found(df).collect()]
        want = brute(rows)
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_report_and_empty(spark):
    df = spark.createDataFrame(corpus(3, 60), SCHEMA)
    pairs = near_copies(df)
    rows = report(df).collect()
    assert all(r.coverage is None or 0 < r.coverage <= 1 for r in rows)
    assert sum(r.links for r in rows) == pairs.count() and sum(r.clips for r in rows) == df.where("split <> 'train'").count()
    assert found(df.limit(0)).count() == 0
    assert found(df.where("split = 'train'")).count() == 0
