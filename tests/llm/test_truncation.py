import pytest

from corpusloom.llm.truncation import ASK_ELLIPSIS, ASK_WORD, CUT, MARKED, OPEN, OPEN_AFTER, PHRASE, WHOLE, by_source, ending, last_token, truncated
from corpusloom.llm.wordtrie import last_words, word_counts

CASES = [
    (None, "chapter", None), ("", "chapter", None), (" \n", "chapter", None),
    ("It was late.", "chapter", WHOLE), ("“It was late.”", "chapter", WHOLE), ("It was la", "chapter", OPEN), ("It was late,", "chapter", PHRASE), ("He slept. It was\n", "blurb", OPEN_AFTER),
    ("It was late.\n– Ann, Kestrel-Row", "chapter", WHOLE), ("It was late.\n(recorded in X)", "chapter", WHOLE), ("It was late.\n(recorded in", "chapter", OPEN_AFTER), ("It was late.\nTHE END", "chapter", WHOLE),
    ("It was late.\n#a #b", "notes", WHOLE), ("It was late.\nhttps://x.example/y", "notes", WHOLE), ("It was late.\nTotal: 27 clips", "notes", WHOLE), ("It was late.\n28 / 46", "notes", WHOLE),
    ("It was late.\n♪ old sacks ♪", "notes", WHOLE), ("It was late.\n<3", "notes", WHOLE), ("It was late.\n🎧", "notes", WHOLE), ("It was late.\n- The quick valley", "notes", OPEN_AFTER), ("It was late.\n- Ann slept.", "notes", WHOLE),
    ("It was late…", "chapter", ASK_ELLIPSIS), ("“It was late…”", "chapter", WHOLE), ("It was la [...]", "chapter", MARKED), ("It was la (more)", "blurb", MARKED), ("It was late. [...]", "blurb", WHOLE),
    ("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nHi there.", "vtt", WHOLE), ("WEBVTT\n\n00:00:01.000 --> 00:00", "vtt", CUT),
    ('{"messages": [{"role": "user", "content": "Hi."}]}', "chat", WHOLE), ('{"messages": [{"role": "user", "content": "Hi', "chat", CUT), ('{"messages": [{"role": "user", "content": "Hi…”"}]}', "chat", WHOLE), ('{"messages": [{"role": "user", "content": "Hi…"}]}', "chat", ASK_ELLIPSIS),
    ("the kettle slept", "captions", ASK_WORD), ("毎晩老人が静かな船を描いた。", "article", WHOLE), ("毎晩老人が静かな船と", "article", OPEN), ("老人が。毎晩老人が静かな船と", "article", OPEN_AFTER), ("船を�", "article", CUT),
]


@pytest.mark.parametrize("text,kind,want", CASES)
def test_endings(text, kind, want):
    got = ending(text, kind)
    assert (got and got[0]) == want


def test_trie(spark):
    texts = spark.createDataFrame([("the kitchen and the kitten. kitchen here",), ("the kitchen and kit",), (None,), ("",)], "text string")
    vocabulary = word_counts(texts)
    counts = {r.word: (r.n, r.n_end) for r in vocabulary.collect()}
    assert counts["kitchen"] == (3, 0) and counts["kitten"] == (1, 1) and "kit" not in counts and "here" not in counts
    tokens = spark.createDataFrame([("kit",), ("kitchen",), ("zzz",), ("",)], "token string")
    assert {r.token: r.cut for r in last_words(tokens, vocabulary).collect()} == {"kit": True, "kitchen": False, "zzz": False}


def test_documents(spark):
    whole = [(i, f"Because the kettle slept, the old garden waited number {i % 7} again and the garden slept.", "s", "chapter") for i in range(40)]
    cut = [(100, "Because the kettle slept, the old gard", "s", "chapter"), (101, "because the kettle slept the old gard", "s", "captions"), (102, "the old garden", None, "captions"), (103, "The old garden slept…", "s", "blurb"), (104, "The old gard…", "s", "blurb")]
    df = spark.createDataFrame([(*r, 0) for r in whole + cut + [(105, None, "s", None), (105, None, "s", None), (106, "", "s", "chapter")]], "doc_id long, text string, source string, kind string, n int")
    marked = truncated(df)
    got = {r.doc_id: (r.truncated, r.evidence) for r in marked.collect()}
    assert {i: w for i, (t, w) in got.items() if t} == {100: "word", 101: "word", 104: "word"} and 105 not in got and 106 not in got
    assert {r.source: r.n_truncated for r in by_source(marked).collect()} == {"s": 3, None: 0}
    assert truncated(df.limit(0)).count() == 0


def test_short_lines_cut_inside_a_word(spark):
    whole = [(i, f"Because the kettle slept, the old garden waited number {i % 7} again and the garden slept.", "s") for i in range(40)]
    ends = ["– said the old gard", "Note: the old gard", "-- the gard", "– said the old garden", "Note: the old kettle", "– Ann, Kestrel-Row", "Total: 27", "Link: https://x.example/gard", "– said the old garden.", "(the old gard)"]
    df = spark.createDataFrame([(*r, "chapter") for r in whole] + [(100 + i, "It was late.\n" + x, "s", "chapter") for i, x in enumerate(ends)], "doc_id long, text string, source string, kind string")
    assert {r.doc_id for r in truncated(df).where("evidence = 'word'").collect()} == {100, 101, 102} == {r.doc_id for r in truncated(df).where("truncated").collect()}


def test_unpunctuated_whole_texts_are_kept(spark):
    """Neither titles of a source that ends its sentences nor unfinished-looking texts of one that does not are cut."""
    whole = [(i, f"Because the kettle slept, the old garden waited number {i % 7} again. The weather of the city was in the report and the garden slept.", "s") for i in range(40)]
    titles = [(100, "Guide to the best coffee in northern Lisbon", "s"), (101, "Weather report for the whole city of Paris today", "s")]
    notes = [(200 + i, f"buy milk. call number {i}. water the garden", "notes") for i in range(20)]
    cut = [(300, "The kettle slept. The old garden waited number", "s"), (301, "The weather of the city was in the", "s"), (302, "The weather of the city, the old gard", "notes")]
    df = spark.createDataFrame([(*r, "blurb") for r in whole + titles + notes + cut], "doc_id long, text string, source string, kind string")
    got = {r.doc_id: r.evidence for r in truncated(df).where("truncated").collect()}
    assert got == {300: "phrase", 301: "phrase", 302: "word"}
    more = spark.createDataFrame([(303, "The kettle slept. Then came a stranger", "s", "blurb")], df.schema)
    got = {r.doc_id: r.evidence for r in truncated(df.unionByName(more)).where("truncated").collect()}
    assert got == {300: "phrase", 301: "phrase", 302: "word", 303: "sentence"}


def test_length_decides(spark):
    """Texts without a full stop at a length where their source's texts pile up."""
    base = "the lamp of the old house by the river stood for many years and the people of the town "
    rows = [(i, (base + str(i % 10) + " went home")[:97].ljust(97, "e"), "limit", "blurb") for i in range(15)]
    rows += [(100 + i, base + "w" * (i + 20), "limit", "blurb") for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, kind string")
    got = {r.doc_id: (r.evidence, r.at_limit) for r in truncated(df).collect()}
    assert all(got[i] == ("length", True) for i in range(15)) and all(got[100 + i] == (None, False) for i in range(15))
    assert {(r.n_truncated, r.n_length, r.n_at_limit) for r in by_source(truncated(df)).collect()} == {(15, 15, 15)}


def test_words_of_any_length(spark):
    long, longer = "a" * 41, "b" * 200
    assert last_token("x " + longer) == longer and last_token(longer) == longer and last_token("x." + longer + "”") == longer
    texts = [(f"see {long}kit and {longer}kit here. see {long}kit and {longer}kit.",), (f"{long}kit {longer}kit.",)]
    vocabulary = word_counts(spark.createDataFrame(texts, "text string"))
    assert {r.word: r.n for r in vocabulary.collect()}[long + "kit"] == 3
    tokens = spark.createDataFrame([(long,), (longer,), (long + "kit",)], "token string")
    assert {r.token: r.cut for r in last_words(tokens, vocabulary).collect()} == {long: True, longer: True, long + "kit": False}
