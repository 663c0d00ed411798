import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text, udfs


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def spoken(n):
    """Independent number words."""
    ones, tens = text.ONES, ["", "", *text.TENS]
    if n < 20:
        return ones[n]
    if n < 100:
        return tens[n // 10] + (" " + ones[n % 10] if n % 10 else "")
    if n < 1000:
        return ones[n // 100] + " hundred" + (" " + spoken(n % 100) if n % 100 else "")
    return ones[n // 1000] + " thousand" + (" " + spoken(n % 1000) if n % 1000 else "")


def test_number_words(spark):
    rows = spark.range(-1, 10_001).select("id", text.number_words_column(F.col("id")).alias("w")).collect()
    for r in rows:
        want = spoken(r.id) if 0 <= r.id <= 9999 else None
        assert r.w == want and (text.number_words(r.id) or None) == (want and want.split())


@pytest.mark.parametrize("value,f,want", [
    ("It’s—so 1,205/well-known  42!", text.match_tokens, "its so 1205 well known forty two".replace("1205", "one thousand two hundred five").split()),
    ("Don't-stop, 5!", text.cue_tokens, ["don't", "stop", "5"]), ("Twenty 3 big, dogs", text.coverage_tokens, ["big", "dogs"]),
    ("a[break]b [pause:0.3]C!", text.speech_text, "a b c"), ("IV: The Hill, II", text.heading_tokens, ["the", "hill", "ii"]), ("Éa  b!", text.title_key, "éa b"),
    ("Room 12, (7) b2 99999.", text.expand_digits, "Room twelve, (seven) b2 99999."), ("x 12 b2", text.digit_leftovers, ["b2"]), ('“a" b”', text.quote_marks, 3),
    ("End. 12 The", text.endnote_marks, 1), ("A b.  C d! e", text.sentences, ["A b.", "C d!", "e"]), ("A b. C d!” e", text.closed_sentences, ["A b.", "C d!”"]),
    ("well,”", text.tail_seconds, 0.2), ("well.", text.tail_seconds, 0.4), ("01:02:03.500", text.seconds_of, 3723.5), ("2:03", text.seconds_of, 123.0), ("x", text.seconds_of, None),
    ("How A B #shorts", text.clean_title, "How A B"), ("How A - Part 2 | P3", text.clean_title, "How A"), ("P3", text.clean_title, "P3"), ("", text.clean_title, ""),
    ("a\nhttps://x\n\n\n\nSubscribe now\nb ", text.without_boilerplate, "a\n\nb"),
])
def test_columns(spark, value, f, want):
    assert one(spark, value, f) == want
    assert one(spark, None, f) is None


def test_stamps(spark):
    rows = spark.createDataFrame([(3723.5,), (59.9996,), (0.0,)], "s double").select(text.stamp_of(F.col("s")).alias("t")).collect()
    assert [r.t for r in rows] == ["01:02:03.500", "00:01:00.000", "00:00:00.000"]


@pytest.mark.parametrize("body,title,want", [("How A\nb", "How A #x", "b"), ("how a!\nb\nc", "How A", "b\nc"), ("How A", "How A", ""), ("b\nHow A", "How A", "b\nHow A"), ("", "x", ""), ("x", "", "x")])
def test_title_echo(spark, body, title, want):
    df = spark.createDataFrame([(body, title)], "b string, t string")
    assert df.select(text.without_title_echo(F.col("b"), F.col("t"))).first()[0] == want


@pytest.mark.parametrize("n", [0, 5, 6, 7, 12])
def test_ngrams(spark, n):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(text.word_ngrams(F.col("w"), 6)).first()[0] == [" ".join(words[i : i + 6]) for i in range(n - 5)]


def pack(parts, most):
    out, cur = [], ""
    for s in parts:
        if not cur:
            cur = s
        elif len(cur) + 1 + len(s) <= most:
            cur += " " + s
        else:
            out.append(cur)
            cur = s
    return out + ([cur] if cur else [])


def test_packing(spark):
    cases = [[], ["a" * 10], ["a" * 30, "b"], ["aa", "bb", "cc", "dd"], ["x" * i for i in range(1, 15)]]
    df = spark.createDataFrame([(c,) for c in cases], "p array<string>")
    assert [r[0] for r in df.select(text.pack_sentences(F.col("p"), 12)).collect()] == [pack(c, 12) for c in cases]
    merged = df.select(text.merge_fragments(F.col("p"), 3)).collect()
    assert merged[3][0] == ["aa bb cc dd"] and merged[0][0] == []


def test_rolling_dedupe_compares_with_the_last_kept(spark):
    df = spark.createDataFrame([(["A", "A", "AB", "B", "C"],), ([],)], "l array<string>")
    assert [r[0] for r in df.select(text.rolling_dedupe(F.col("l"))).collect()] == [["A", "AB", "C"], []]


def test_edit_ratio(spark):
    df = spark.createDataFrame([("Abc", "abd"), ("", "x"), ("same", "SAME")], "a string, b string")
    assert [round(r[0], 4) for r in df.select(text.edit_ratio(F.col("a"), F.col("b"))).collect()] == [0.3333, 1.0, 0.0]


def test_html():
    t, heads = udfs.html_parts("<h1>A &amp; B</h1><script>x='</p>'</script><p>one<sup>55</sup> two<ul><li>u</p>v")
    assert heads == ["A & B"] and t.split("\n") == ["A & B", "one twou", "v"]


def test_spoken_forms():
    assert udfs.spoken_scripture("1 John 1:9 and 5:16-18, 2:3ff.") == "First John one nine and five sixteen through eighteen, two three"
    assert udfs.regnal_names("Pius XII and Leo the ten, John XXIII, John ten, Benedict twenty-two") == ("Pius the Twelfth and Leo the Tenth, John the Twenty-Third, John ten, Benedict the Twenty-Second", 4)


def plain_lcs(a, b):
    dp = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            dp[i + 1][j + 1] = dp[i][j] + 1 if x == y else max(dp[i][j + 1], dp[i + 1][j])
    return dp[-1][-1]


def test_similarity(spark):
    import random

    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.choice("abc") for _ in range(r.randint(0, 70))] for _ in range(2))
        assert udfs.longest_common(a, b) == plain_lcs(a, b)
    assert udfs.word_error_rate("a b c d".split(), "a x c".split()) == 0.5 and udfs.word_error_rate([], []) == 0 and udfs.word_error_rate([], ["a"]) == 1
    df = spark.createDataFrame([("abc", "abc"), ("", ""), ("", "x"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(udfs.text_ratio(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0, 0.0, None]
    long = ["x"] * 300
    assert udfs.ratio(long, long, True) != udfs.ratio(["y"], ["y"], True) or math.isclose(udfs.ratio(long, long), 1.0)
