import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.pairs import PhraseAutomaton, SuffixAutomaton, copied, defective_pairs, inspect, is_empty, is_refusal, other_language, unclosed

PROSE = "The kettle of Saltwick slept beside the old garden. When the door froze, Ann painted nine wooden chairs and left. Nobody in Quillbay had noticed the damp island."


@pytest.mark.parametrize("title", [None, "", "  ", "​", "-", "...", "#shorts", "(untitled)", "N/A", "TBD", "[title]", "(empty)", "<blank>", " \n"])
def test_empty(title):
    assert is_empty(title)


@pytest.mark.parametrize("title", ["The Journal!", "N/A Means Nothing in Saltwick", "日本", "1984", "Empty Rooms", "Empty", "Empty | P20", "Missing #shorts"])
def test_not_empty(title):
    assert not is_empty(title)


@pytest.mark.parametrize("title", ["I’m sorry, but I can’t write a title for this video!", "AS AN AI MODEL, IT ISN'T POSSIBLE FOR ME TO COMPLY", "[request declined]", "Leider ist mir das nicht möglich.", "Je suis désolé, mais il m’est impossible d’aider.", "Por desgracia, no estoy autorizado a responder", "No title can be suggested for this material.", "That is something I can not do for you.", "Request denied: this description goes against content policy.", "I must decline to answer this.", "Es tut mir leid, aber darf ich bei dieser Anfrage nicht helfen.", "Hello! Regrettably I won't be able to title this one", "Aucun titre ne peut être proposé", "タイトルを作成できません"])
def test_refusal(title):
    assert is_refusal(title)


@pytest.mark.parametrize("title", ["Sorry, We Can't Fix the Northern Easel", "“I Can't Do That”: Ann and the Day Ben Said No", "«No puedo»: Ann dice que no", "Leider verloren: Ann", "Unable to Sleep: The Velvet Inn", "Ann Apologizes for the Mossy Monument", "Désolé, Ann !", "Things I can't live without", "Why I won't buy this again", "No puedo dormir", "I will not go quietly: a life", "Content policy explained", "Je ne peux pas dormir", "Ich kann nicht schlafen", "I Can't Help Falling", "No Title Can Hold Me", "Request: A Song", "Leider nicht möglich: Ann", "Sorry, I can't swim"])
def test_no_refusal(title):
    assert not is_refusal(title)


def test_copied():
    assert copied("The kettle of Saltwick slept beside the old garden.", PROSE) and copied("TITLE: WHEN THE DOOR FROZE ANN PAINTED NINE WOODEN CHAIRS AND LEFT", PROSE)
    japanese = "毎晩老人が静かな船を描いた。夜明けに船長が古い地図を売った。"
    assert copied("夜明けに船長が古い地図を売った", japanese) and not copied("船長の地図", japanese) and not copied("古い地図と静かな船の話", japanese)
    assert copied("Nobody in had noticed the damp island.", PROSE)
    assert not copied("Why Ann Painted the Door", PROSE) and not copied("The kettle of Ferngate broke behind the new wall", PROSE)
    assert not copied("How Ann Painted Nine Chairs #shorts", "How Ann Painted Nine Chairs\n" + PROSE)
    assert not copied("We Need to Talk About Ann and Ben... | P2", "We Need to Talk About Ann and Ben...\n" + PROSE)


def test_language_and_delimiters():
    assert other_language("Wie Ann mit elf Seiten die Küste in Graubach verließ", PROSE) and other_language("Старик купил серую книгу", PROSE)
    assert not other_language("Ann / Der Hafen: A Jagged Tale", PROSE) and not other_language("How Ann Painted the Door", PROSE) and not other_language("“Ann, ou la Saddle”: An Old Song Explained", PROSE)
    assert unclosed("The Day (Part") and not unclosed("“So” (1)") and not unclosed("Don't") and not unclosed("„Das“: nein")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=20))
def test_suffix_automaton(text, words):
    for start, at, n in SuffixAutomaton(text).matches(words, 1):
        assert words[start : start + n] == text[at : at + n]
    joined = "".join(text)
    longest = max((n for i in range(len(words)) for n in range(1, len(words) - i + 1) if "".join(words[i : i + n]) in joined), default=0)
    assert max((n for *_, n in SuffixAutomaton(text).matches(words, 1)), default=0) <= longest


def test_phrase_automaton():
    a = PhraseAutomaton({"x": "a b|b c d", "y": "c"})
    assert [set(z) for z in a.run("x b c d".split())] == [set(), set(), {"y"}, {"x"}] and set().union(*a.run("a b".split())) == {"x"}
    assert not set().union(*a.run("b d a".split())) and a.run([]) == []


def test_pairs(spark):
    titles = [["How Ann Painted the Door in Saltwick"]] * 60 + [["Why Ben Left the Island in Saltwick"]] * 60
    odd = {500: None, 501: [], 502: ["x", None], 503: ["How Ann Pain"], 504: ["How Ann Painted the"], 505: ["I cannot write a title"], 506: ["The kettle of Saltwick slept beside the old garden."], 507: ["Wie Ann mit elf Seiten die Küste in Graubach verließ"]}
    rows = [(i, f"v{i}", t, "x") for i, t in enumerate(titles)] + [(i, f"v{i}", t, "x") for i, t in odd.items()] + [(503, "v503", odd[503], "x"), (900, "v900", ["No page"], "x"), (901, "v901", None, "x"), (902, None, None, "x")]
    verdicts = spark.createDataFrame(rows, "verdict_id long, video_id string, titles array<string>, description string")
    pages = [(r[1], (None, PROSE, None)) for r in rows if r[1] and r[0] < 900] + [("v901", (None, " \n", None)), ("v900", None)]
    descriptions = spark.createDataFrame(list(dict(pages).items()), "video_id string, snippet struct<title:string,description:string,tags:array<string>>")
    got = sorted((r.verdict_id, r.defect) for r in defective_pairs(verdicts, descriptions).collect())
    assert got == [(500, "empty"), (501, "empty"), (502, "empty"), (503, "truncated"), (503, "truncated"), (504, "truncated"), (505, "refusal"), (506, "copied"), (507, "other_language")]
    assert defective_pairs(verdicts.limit(0), descriptions).count() == 0
    assert inspect("Fine Title Here", "") == (None, "here")


def test_copies_of_a_cut_title_do_not_vouch_for_its_fragment(spark):
    towns = [f"Town{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]

    def found(titles):
        rows = [(i, f"v{i}", [t]) for i, t in enumerate(titles)]
        verdicts = spark.createDataFrame(rows, "verdict_id long, video_id string, titles array<string>")
        descriptions = spark.createDataFrame([(v, (None, PROSE, None)) for _, v, _ in rows], "video_id string, snippet struct<title:string,description:string,tags:array<string>>")
        return {i for i, in defective_pairs(verdicts, descriptions).where("defect = 'truncated'").select("verdict_id").collect()}

    whole = [f"How Ann Painted {t}" for t in towns[:40]]
    # one cut title in a third of the rows, and another one cut to the same fragment
    assert found(whole + ["Why Ben Pain"] * 20 + ["When Cat Pain"]) == set(range(40, 61))
    # 2 of 40 and 20 of 400 are cut alike; a whole word that ends many titles is none
    assert found(whole + [f"Why {t} Pain" for t in towns[:2]]) == {40, 41}
    assert found([f"How Ann Painted {t}" for t in towns] + [f"Why {t} Pain" for t in towns[:20]]) == set(range(400, 420))
    assert found([f"How Ann Tales {t}" for t in towns[:40]] + [f"Why {t} Tale" for t in towns[:12]]) == set()
