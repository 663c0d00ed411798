import unicodedata

from corpusloom.llm.lookalike import CONFUSABLES, canonical, dominant, found_rows, normalize, one_script

SAME = ["plain", "дорога", "λόγος", "café", "“so” – well…", "½ cup", "1st²", "№ 7", "日本語、文。", "a\nb", "it's", "", "👩‍🚀 up"]
FIXED = {
    "ｆｉｎｅ，": "fine,", "oﬀer ﬁve": "offer five", "Chapter Ⅻ.": "Chapter XII.", "Peña": "Peña", "thеm": "them", "Αgain": "Again", "be​gin﻿": "begin",
    "in the　rain": "in the rain", "еѕtuаry": "estuary", "so­ft": "soft", "опe": "опe", "Ꮯat": "Cat", "𝐇ello": "Hello", "𝑥 + 1": "𝑥 + 1", "ꓘing": "ꓘing", "ꓗing": "King",
}


def test_left_alone():
    for t in SAME:
        assert canonical(t) == t


def test_repaired():
    for t, want in FIXED.items():
        assert canonical(t) == want, ascii(t)
        assert canonical(canonical(t)) == canonical(t)


def test_confusables_are_single_letters_of_other_scripts():
    assert all(len(a) == len(b) == 1 and b.isascii() and unicodedata.category(a)[0] == "L" for a, b in CONFUSABLES.items())
    assert not set("ꓘꓞꓤꓥ") & set(CONFUSABLES)  # turned letters look like none
    assert one_script("дорога") is None and one_script("plain") is None and one_script("жуc") == ("cyrillic", "жус")


def test_dominant_script():
    assert [dominant(t) for t in ("thеm", "Москвa", "сap", "λόγoς", "жabc")] == ["latin", "cyrillic", "latin", "greek", "latin"]
    assert one_script("Москвa") == ("cyrillic", "Москва") and one_script("λόγoς") == ("greek", "λόγος") and one_script("plжin") is None


def test_tables(spark):
    clips = spark.createDataFrame([(1, "the them of Москва", "x"), (2, "thеm", "x"), (3, None, "x"), (4, "", "x"), (5, "еxtrа", "x"), (2, "thеm", "x"), (6, "Москвa", "x"), (8, "дорoга", "x")], "clip_id long, text string, row_id string")
    words = spark.createDataFrame([(7, "gla﻿cier"), (8, "word")], "word_id long, word string")
    tables = [("clips", clips, "clip_id", "text"), ("anchored_words", words, "word_id", "word")]
    got = sorted(tuple(r) for r in normalize(tables).collect())
    assert got == [
        ("anchored_words", 7, "gla﻿cier", "glacier", 0, 0), ("clips", 2, "thеm", "them", 1, 0), ("clips", 2, "thеm", "them", 1, 0), ("clips", 5, "еxtrа", "еxtrа", 0, 1), ("clips", 6, "Москвa", "Москва", 1, 0),
    ]
    assert sorted(tuple(r) for r in found_rows(tables).collect()) == [g[:2] for g in got]
    empty = [("clips", clips.limit(0), "clip_id", "text")]
    assert normalize(empty).count() == 0 == found_rows(empty).count()
    assert sorted(r.row_id for r in found_rows([("clips", clips.where("clip_id < 6"), "clip_id", "text")]).collect()) == [2, 2, 5]
