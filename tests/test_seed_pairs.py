"""Queries over pairs of clips that share a seed: against plain loops, and without a broadcast that is only estimated."""

import random
from collections import Counter

import pytest

from corpusloom.functions.udfs import longest_common, ratio, same_characters
from corpusloom.plans import corpus


@pytest.fixture(scope="module")
def clips(spark, tmp_path_factory):
    """(folder, rows): texts with stretches in common, one of them in seven training clips, which is too often for a seed."""
    rng, rows = random.Random(5), []
    stretches = [" ".join(rng.choices("amber bell cove dune elm fern".split(), k=9)) for _ in range(6)]
    for i in range(60):
        own = " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(4, 9)))
        shared = "seven times these very words stand here" if i % 4 and i < 10 else rng.choice(stretches)
        rows.append((i, f'{"Said: " if i % 5 else chr(34)}{own}, {shared}.', "train" if i % 4 else rng.choice(["eval", "holdout"])))
    rows += [(60, None, "train"), (61, "", "eval"), (62, rows[0][1], None), (63, "Seven times these very words stand here", "eval")]
    at = tmp_path_factory.mktemp("clips")
    spark.createDataFrame(rows, "clip_id long, text string, split string").write.parquet(f"{at}/clips.parquet")
    return str(at), rows


def words(text):
    return "".join(x if x.isascii() and (x.isalnum() or x in " '") else " " for x in text.lower().replace("-", " ")).split()


def pairs(rows):
    """Keys of the pairs that share six words in a row which stand at most six times in the training clips."""
    grams = {k: [tuple(w[i : i + 6]) for i in range(len(w) - 5)] for k, t, _ in rows if t is not None for w in [words(t)]}
    book, heard = [k for k, t, s in rows if t is not None and s == "train"], [k for k, t, s in rows if t is not None and s not in ("train", None)]
    often = Counter(g for k in book for g in grams[k])
    assert max(often.values()) > 6
    return {(b, h) for b in book for h in heard if any(often[g] <= 6 for g in {*grams[b]} & {*grams[h]})}


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Broadcast")


def test_classify_route_pairs(spark, clips):
    d, rows = clips
    text = {k: t for k, t, _ in rows}
    df = corpus.classify_route(spark, d)
    got = {(r.book_key, r.heard_key): (r.coverage, r.ratio, r.route == "drop_dialogue") for r in df.collect()}
    want = {}
    for b, h in pairs(rows):
        x, y = words(text[b]), words(text[h])
        want[b, h] = (round(longest_common(x, y) / len(x), 6), round(len(y) / len(x), 6), '"' in text[b])
    assert got == want and want and df.count() == len(want)


def test_ngrams_are_not_broadcast_by_estimate(spark, clips):
    for q in (corpus.seed_anchor, corpus.seed_best_run, corpus.classify_route):
        assert broadcasts(q(spark, clips[0])) == 0, q.__name__


def test_text_similarity_pairs(spark, clips):
    d, rows = clips
    text = {k: " ".join(words(t)) for k, t, _ in rows if t is not None}
    df = corpus.text_similarity(spark, d)
    assert {(r.book_key, r.heard_key): r.sim for r in df.collect()} == {(b, h): round(ratio(text[b], text[h]), 6) for b, h in pairs(rows)}
    assert broadcasts(df) == 0


def test_same_characters_is_difflibs_count():
    rng = random.Random(1)
    for k in range(3000):
        p, q = ("".join(rng.choices(("ab", "abc ", "abcdefgh é")[k % 3], k=rng.randrange(30))) for _ in range(2))
        assert 2.0 * same_characters(p, q) / (len(p) + len(q) or 1) == (ratio(p, q) if p or q else 0.0)
