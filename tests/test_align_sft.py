import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import align, sft


def heard(words, step=0.5):
    return [{"word": w, "start": round(i * step, 3), "end": round(i * step + step, 3)} for i, w in enumerate(words)]


def test_stream():
    tokens, of = align.stream(["Twenty-one", "It’s", "42", "—", "12345"])
    assert tokens == ["twenty", "one", "its", "forty", "two", "12345"] and of == [0, 0, 1, 2, 2, 4]


def test_fused_words(spark):
    words = spark.createDataFrame([(1, "“matamundi,", 1.0, 2.0), (2, "x", 2.0, 3.0), (3, None, 3.0, 4.0), (4, "Bb", 4.0, 4.1)], "pos int, word string, start double, end double")
    fixes = spark.createDataFrame([("matamundi", ["Mater", "Mundi"]), ("bb", ["B", "B", "C"]), ("bb", ["B", "B", "C"]), ("none", [])], "token string, parts array<string>")
    got = [tuple(r) for r in align.split_fused(words, fixes).orderBy("pos", "part").collect()]
    assert got[:4] == [(1, "“Mater", 1.0, 1.5, 0), (1, "Mundi,", 1.5, 2.0, 1), (2, "x", 2.0, 3.0, 0), (3, None, 3.0, 4.0, 0)]
    assert got[4:] == [(4, "B", 4.0, 4.033, 0), (4, "B", 4.033, 4.067, 1), (4, "C", 4.067, 4.1, 2)]
    assert align.split_fused(words.limit(0), fixes).count() == 0


WORDS, HEARD = "stem string, pos int, word string", "stem string, pos int, word string, start double, end double"


def two(spark, book, told, stem="s"):
    rows = [(stem, i, h["word"], h["start"], h["end"]) for i, h in enumerate(heard(told))]
    return spark.createDataFrame([(stem, i, w) for i, w in enumerate(book)], WORDS), spark.createDataFrame(rows, HEARD)


def test_window_alignment(spark):
    book, told = two(spark, "front matter The kettle slept beside the old garden today".split(), "the kettle slapt beside garden now".split())
    out = align.align_window(book, told, "stem").orderBy("pos").collect()
    assert out[0].word == "The" and out[-1].word == "garden" and [r.pos for r in out] == list(range(2, 9))
    by = {r.word: r for r in out}
    assert by["slept"].corr and by["old"].corr and not by["kettle"].corr and (by["slept"].start, by["slept"].end) == (1.0, 1.5)
    assert (by["the"].start, by["the"].end, by["old"].start, by["old"].end) == (2.0, 2.0, 2.0, 2.0)  # nothing is left between beside and garden
    gap = align.align_window(book, told.where("word <> 'beside'"), "stem").collect()
    assert {r.word: (r.start, r.end) for r in gap}["garden"] == (2.0, 2.5)
    none = two(spark, ["a"], ["x"])
    assert [r.corr for r in align.align_window(*none, "stem").collect()] == [True] and align.align_window(book.limit(0), told.limit(0), "stem").count() == 0


def test_shares_of_what_was_heard(spark):
    book, told = two(spark, "the kettle of copper slept".split(), "the pot slept".split())
    out = {r.word: (r.start, r.end) for r in align.align_window(book, told, "stem").collect()}
    assert out == {"the": (0.0, 0.5), "kettle": (0.5, 0.667), "of": (0.667, 0.833), "copper": (0.833, 1.0), "slept": (1.0, 1.5)}
    told = told.where("word <> 'pot'")
    out = {r.word: (r.start, r.end) for r in align.align_window(book, told, "stem").collect()}
    assert out["kettle"] == (0.5, 0.667) and out["copper"] == (0.833, 1.0)


def test_auto_anchor(spark):
    book, told = two(spark, "a b c d e f g h".split(), "E, f g".split())
    r = align.auto_anchor(book, told, "stem", margin=1).first()
    assert (r.start, r.a, r.b, r.size) == (3, 4, 0, 3)
    assert align.auto_anchor(*two(spark, ["a"], ["x"]), "stem").first().size == 0
    r = random.Random(3)
    import difflib

    for _ in range(3):
        b, h = ([r.choice("abcd") for _ in range(n)] for n in (60, 20))
        m = difflib.SequenceMatcher(None, b, h, autojunk=False).find_longest_match()
        got = align.auto_anchor(*two(spark, b, h), "stem", margin=0).first()
        assert (got.a, got.b, got["size"]) == (m.a, m.b, m.size)


def test_global_alignment(spark):
    r = random.Random(1)
    book = [f"w{r.randint(0, 400)}" for _ in range(600)]
    told = ["intro", "words", "here"] + book[100:160] + ["extra"] * 14 + book[300:340]
    told[20] = "misheard"
    out = align.aligned_sources(*two(spark, book, told), "stem").orderBy("pos").collect()
    used = [w.book_idx for w in out if w.source == "book"]
    assert len(used) == len(set(used)) and set(range(100, 160)) <= set(used) and set(range(300, 340)) <= set(used)
    assert sum(w.source == "whisper" for w in out) >= 16 and all(a.start <= b.start for a, b in zip(out, out[1:]))
    empty = two(spark, [], ["a"] * 9)
    assert {w.source for w in align.aligned_sources(*empty, "stem").collect()} == {"whisper"} and align.aligned_sources(*two(spark, book, []), "stem").count() == 0


def test_words_only_in_the_book(spark):
    """The first takes the whole gap, the others none; a run of more than eight is dropped."""
    book = [f"w{i}" for i in range(60)]
    told = book[:20] + book[23:40] + book[50:]
    rows = [(i, w, float(i), i + 0.5) for i, w in enumerate(told)]
    h = spark.createDataFrame([("s", *r) for r in rows], HEARD)
    out = {r.book_idx: (r.start, r.end) for r in align.aligned_sources(spark.createDataFrame([("s", i, w) for i, w in enumerate(book)], WORDS), h, "stem").collect()}
    assert out[20] == (19.5, 20.0) and out[21] == out[22] == (20.0, 20.0) and not set(range(40, 50)) & set(out)


def test_aligned_sources(spark):
    words = "the kettle of the town slept beside the old garden for an hour".split()
    book = spark.createDataFrame([("s", i, w) for i, w in enumerate(words)], "stem string, pos int, word string")
    told = spark.createDataFrame([("s", i, w, float(i), i + 1.0) for i, w in enumerate(["so", *words])], "stem string, pos int, word string, start double, end double")
    rows = align.aligned_sources(book, told, "stem").orderBy("pos").collect()
    assert [r.word for r in rows] == ["so", *words] and [r.source for r in rows][:2] == ["whisper", "book"]
    chapters = spark.createDataFrame([("s", "one", 0, 5), ("s", "two", 5, 8)], "stem string, chapter string, word_start int, word_end int")
    got = {r.book_idx: r.chapter for r in align.chapter_of(align.aligned_sources(book, told, "stem"), chapters, "stem").collect()}
    assert got[0] == "one" and got[5] == "two" and got[11] == "two" and got[None] == "two"


def test_routes(spark):
    rows = [(False, 0.9, 1.0, False, -0.1, 0.1, "verbatim"), (False, 0.9, 2.0, False, -0.1, 0.1, "overrun"), (True, 0.9, 1.0, False, 0.0, 0.0, "drop_dialogue"), (False, 0.5, 0.4, False, 0.0, 0.0, "drop_shrink"), (False, 0.5, 1.0, False, -2.0, 0.0, "drop_lowconf"),
            (False, 0.9, 1.0, True, 0.0, 0.0, "hole"), (False, 0.6, 1.5, False, 0.0, 0.0, "expansion"), (False, 0.6, 1.0, False, 0.0, 0.9, "drop_lowconf"), (False, 0.6, 1.0, False, 0.0, 0.0, "divergent"), (False, None, None, False, 0.0, 0.0, "drop_shrink")]
    df = spark.createDataFrame(rows, "d boolean, c double, r double, h boolean, l double, n double, want string")
    got = df.select(align.correction_route(*(F.col(c) for c in "dcrhln")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    ends = [("a b c", [("a", 1.0), ("x", 2.0), ("b", 3.0), ("c", 4.0)], 4.0), ("a b c", [("a", 1.0)], None), (None, [("a", 1.0)], None), ("a b", [], None)]
    df = spark.createDataFrame(ends, "t string, h array<struct<w:string,end:double>>, want double")
    assert all(r.got == r.want for r in df.select(align.tightened_end(F.split("t", " "), F.col("h")).alias("got"), "want").collect())


def test_fill_times(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])], "k string, i int, v double")
    assert [r.v for r in align.fill_times(df, ["k"], "i", "v").orderBy("i").collect()] == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_chat(spark):
    good = '{"messages": [{"role": "user", "content": "a b"}, {"role": "assistant", "content": "c"}]}'
    rows = [good, '{"messages": []}', '{"messages": [{"role": "user", "content": null}, {"role": "assistant", "content": "c"}]}', '{"messages": [{"role": "user", "content": "x"}]}', "{}", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    assert [r[0] for r in df.select(sft.chat_problem(sft.chat_messages(F.col("t")))).collect()] == [None, "no messages", "not text", "last role", "no messages", "no messages"]


def test_masks(spark):
    spans = [("user", [1, 2]), ("assistant", [3]), ("user", []), ("assistant", [4, 5])]
    df = spark.createDataFrame([(spans,)], "s array<struct<role:string,ids:array<int>>>")
    e = df.select(sft.encode_chat(F.col("s"), 5).alias("e")).first().e
    assert (e.input_ids, e.labels, e.attention_mask) == ([1, 2, 3, 4, 5], [-100, -100, 3, 4, 5], [1] * 5)
    for bad, most in ((spans, 4), ([("user", [1])], 9)):
        with pytest.raises(Exception, match="longer|no assistant"):
            spark.createDataFrame([(bad,)], "s array<struct<role:string,ids:array<int>>>").select(sft.encode_chat(F.col("s"), most)).collect()
    p = spark.createDataFrame([([[1], [1, 2], [1, 2, 3, 4]],), ([[1], [2, 3]],)], "p array<array<int>>")
    got = p.select(sft.prefix_monotonic(F.col("p")).alias("ok"), sft.spans_from_prefixes(F.col("p")).alias("s")).collect()
    assert [g.ok for g in got] == [True, False] and got[0].s == [[1], [2], [3, 4]]


def test_frames(spark):
    books = ([1, 2], [3, 4, 5, 6], [7, 8, 9, 10, 11, 12, 13, 14])
    df = spark.createDataFrame([books, ([], [], [])], "a array<int>, b array<int>, c array<int>")
    ids = df.select(sft.interleave([F.col(x) for x in "abc"]).alias("ids"), "a", "b", "c")
    first = ids.collect()[0].ids
    base = sft.CODE_BASE
    assert first[:7] == [base + v + s * 4096 for s, v in enumerate([1, 3, 7, 8, 4, 9, 10])] and len(first) == 14
    back = ids.select(*(c.alias(n) for c, n in zip(sft.deinterleave(F.col("ids")), "xyz")), "a", "b", "c").collect()
    assert all((r.x, r.y, r.z) == (r.a, r.b, r.c) for r in back)
    odd = spark.createDataFrame([(first[:-1],), ([1] * 7,), (first,)], "i array<int>")
    assert [r[0] for r in odd.select(sft.in_slots(F.col("i"))).collect()] == [False, False, True]
    runs = spark.createDataFrame([([1] * 7 + [1] + [2] * 6 + [3] * 7 + [1] * 7,), ([],), ([1, 2],)], "i array<int>")
    assert [r[0] for r in runs.select(sft.without_repeated_frames(F.col("i"))).collect()] == [[1] * 7 + [3] * 7 + [1] * 7, [], None]
    x = spark.createDataFrame([([5, 6], [7])], "t array<int>, c array<int>").select(*(c.alias(n) for c, n in zip(sft.framed_prompt(F.col("t"), F.col("c")), "xl"))).first()
    assert x.x == [128259, 5, 6, 128009, 128260, 128261, 128257, 7, 128258, 128262] and x.l == [-100] * 7 + [7, 128258, 128262]
