"""Text cut off by field limits: the last word against a corpus trie, combined with length spikes and with the sentence
ends of the text and its source; record and cue structure where there is any."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.wordtrie import WORD, last_words, word_counts
from corpusloom.session import checked_broadcast, materialize

_CLOSERS = "\"'”’»›)]』」*_`"
_TERMINAL = ".!?。！？"
_MARK = re.compile(r"(?:\[(?:\.{2,}|…)\]|\((?:\.{2,}|…)\)|[\[(](?:more|read more|continued|truncated|mehr|suite|más)[\])])\s*$", re.I)
_ELLIPSIS = re.compile(r"(?:…|\.{2,})\s*$")
_TAGS = re.compile(r"(?:\s*</?[a-zA-Z][^<>]{0,40}>)+\s*$")
_CUE_TIME = re.compile(r"^\d[\d:.,\s>-]*$")
_LINK = re.compile(r"(?:https?://|www\.)\S+$|\S+@\S+\.\w+$", re.I)
_LABEL = re.compile(r"^[^\W\d_][\w]*(?: \w+)?\s?: \S")
#: Bounds of what counts as a caption under a text (words, characters).
CAPTION_WORDS, CAPTION_CHARS = 6, 60

# Fixed value: kana in which a Japanese sentence without its full stop commonly ends.
_JAPANESE_END = "ただるすいんうねよかくむつぬぶぐ"

# What is known of a text before the corpus is asked. CUT: its record or cue is broken. MARKED: a mark of abridgement
# stands after an unfinished sentence. PHRASE: it ends in a comma or the like. OPEN: it ends without a full stop, and
# no sentence in it is ended; OPEN_AFTER: the same after sentences that are.
WHOLE, CUT, MARKED, PHRASE, OPEN, OPEN_AFTER, ASK_WORD, ASK_ELLIPSIS = "whole", "cut", "marked", "phrase", "open", "open_after", "ask_word", "ask_ellipsis"
_ENDED = re.compile(r"[.!?][\"'”’»)\]]*\s|[。！？]")


def is_caption(line: str) -> bool:
    """A last line that is no prose: signature, credit, tag, link, heading, count, song, sign or label, and complete."""
    words = line.split()
    if _LINK.search(line) or all(w[0] == "#" and len(w) > 1 for w in words):
        return True
    if line[0] in "([♪":
        return line[-1] == {"(": ")", "[": "]", "♪": "♪"}[line[0]] and len(line) > 1
    if unicodedata.category(line[-1]) in ("So", "Sk", "Sm", "Cn", "Co") or re.search(r"[<:;]['-]?[3)(DP]$", line):
        return line[-1] != "�"
    if len(words) > CAPTION_WORDS or len(line) > CAPTION_CHARS:
        return False
    if line[0] in "–—~" or line.startswith("--"):
        return True
    letters = [c for c in line if c.isalpha()]
    if line[-1].isdigit() or _LABEL.match(line):
        return True
    return len(words) > 1 and len(letters) > 3 and line.upper() == line and line.lower() != line


def asks_word(line: str) -> bool:
    """A caption that may be prose all the same: known only by how it begins (a dash, 'Label: x'), and ending in a word."""
    return (line[0] in "–—~" or line.startswith("--") or _LABEL.match(line) is not None) and not _LINK.search(line) and last_token(line) != ""


def last_token(text: str) -> str:
    """The last word of a text in lower case, of any length, if nothing but closers stands after it; else ''."""
    bare = text.rstrip().rstrip(_CLOSERS + " ")
    size = 80
    while True:
        tail = bare[-size:].lower()
        words = WORD.findall(tail)
        if not words or not tail.endswith(words[-1]) or words[-1][-1] in _TERMINAL:
            return ""
        if len(words[-1]) < len(tail) or size >= len(bare):
            return words[-1]
        size *= 2  # the word goes on before


def ending(text: str | None, kind: str | None) -> tuple[str, str] | None:
    """(state, last token) of a text, the token of a whole one only if it is whole unless its last word is cut; None for a null, empty or blank one."""
    if text is None or not text.strip():
        return None
    s = text.rstrip()
    if s[0] == "{" or kind == "chat":
        if s[0] in "{[":
            try:
                record, _ = json.JSONDecoder(strict=False).raw_decode(s)
            except ValueError:
                return CUT, last_token(s)
            while isinstance(record, (dict, list)) and record:
                record = list(record.values())[-1] if isinstance(record, dict) else record[-1]
            if not isinstance(record, str) or not record.strip():
                return WHOLE, ""
            s = record.rstrip()
            return (ASK_ELLIPSIS, last_token(_ELLIPSIS.sub("", s))) if _ELLIPSIS.search(s) else (WHOLE, "")
    if s[-1] == "�":
        return CUT, ""
    if kind == "captions":
        plain = _ELLIPSIS.sub("", _MARK.sub("", s).rstrip()).rstrip()
        return (ASK_WORD, last_token(plain)) if plain else (WHOLE, "")
    last = s.rsplit("\n", 1)[-1].strip()
    if (kind == "vtt" or s.startswith("WEBVTT")) and (_CUE_TIME.match(last) or last == "WEBVTT"):
        return (CUT, "") if last != "WEBVTT" else (WHOLE, "")
    if m := _MARK.search(s):
        plain = s[: m.start()].rstrip()
        done = plain.rstrip(_CLOSERS)[-1:]
        return (WHOLE, "") if done and done in _TERMINAL else (MARKED, last_token(plain))
    if is_caption(last) and not (last.startswith("- ") or last.startswith("* ")):
        return WHOLE, last_token(last) if asks_word(last) else ""
    s = _TAGS.sub("", s) or s
    if m := _ELLIPSIS.search(s):
        before = s[: m.start()]
        if before and "\u3040" <= before[-1] <= "\u9fff":
            return (WHOLE if before[-1] in _JAPANESE_END else CUT), ""
        return ASK_ELLIPSIS, last_token(before)
    bare = s.rstrip(_CLOSERS + " ")
    if bare and _ELLIPSIS.search(bare):
        return WHOLE, ""  # the quotation was closed after the dots
    if bare and bare[-1] in _TERMINAL:
        return WHOLE, ""
    if s[-1] in ",;:，、；：":
        return PHRASE, ""
    return (OPEN_AFTER if _ENDED.search(s) else OPEN), last_token(s)


ENDINGS = "doc_id long, source string, kind string, n_chars int, ended boolean, state string, token string"


def endings(documents: DataFrame) -> DataFrame:
    """doc_id, source, kind, n_chars (of the text), ended (its last character but closers is a full stop), state, token (null
    if there is none to ask for) of each text that is neither null nor blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, source, kind, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (e := ending(text, kind)) is not None:
                    rows.append((doc, source, kind, len(text), text.rstrip().rstrip(_CLOSERS + " ")[-1:] in tuple(_TERMINAL), e[0], e[1] or None))
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "source", "kind", "n_chars", "ended", "state", "token"])

    return documents.select("doc_id", "source", "kind", "text").mapInArrow(run, ENDINGS)


#: A length is a field limit of a source if this many texts have it, and this many times as many as any of the lengths next to it.
SPIKE_TEXTS, SPIKE_TIMES = 12, 6
#: From this many occurrences on, a word that ends a sentence in less than this share of them does not end one here.
SEEN, END_SHARE = 20, 0.004


def length_limits(lengths: DataFrame) -> DataFrame:
    """(source, n_chars) at which the texts of a source pile up: the evidence of a field limit."""
    counts = lengths.groupBy("source", "n_chars").agg(F.count("*").alias("at"))
    around = counts.select("source", F.explode(F.array(F.col("n_chars") - 1, F.col("n_chars") + 1)).alias("n_chars"), F.col("at").alias("beside"))
    beside = around.groupBy("source", "n_chars").agg(F.max("beside").alias("beside"))
    spikes = counts.join(beside, ["source", "n_chars"], "left").where((F.col("at") >= SPIKE_TEXTS) & (F.col("at") >= SPIKE_TIMES * F.coalesce("beside", F.lit(0))))
    return spikes.select("source", "n_chars", F.lit(True).alias("at_limit"))


#: Texts of a source and kind end their sentences if at least this share of those that end in a word or a full stop end in the latter.
HABIT = 0.5


def habits(ends: DataFrame) -> DataFrame:
    """(source, kind, habit): the share of full stops at the end of texts that end in a word or a full stop."""
    stop, word = F.col("ended") & (F.col("state") == WHOLE), F.col("state").isin(OPEN, OPEN_AFTER)
    return ends.where(stop | word).groupBy("source", "kind").agg((F.count_if(stop) / F.count("*")).alias("habit"))


def evidence(state: Column, cut_word: Column, n: Column, n_end: Column, at_limit: Column, habit: Column) -> Column:
    """What says that a text broke off, null if nothing does: structure, mark, word (its last word is a proper prefix of
    words and none itself), phrase (it ends in a comma, or in a word that ends no sentence where its source ends them), length (its source's texts
    pile up at its length) or sentence (it and its source end their sentences, but not this one).

    A text that ends in a word without a full stop is whole unless one of these says otherwise; so is one that ends in
    dots. At a length where texts pile up fewer occurrences of the last word are enough."""
    seen = F.when(at_limit, SEEN / 4).otherwise(SEEN)
    never_last = (n >= seen) & (n_end < n * END_SHARE)
    is_open = state.isin(OPEN, OPEN_AFTER)
    return (
        F.when(state == CUT, "structure").when(cut_word, "word").when(state == MARKED, "mark").when((state == PHRASE) | (((is_open & (habit >= HABIT)) | (state == ASK_ELLIPSIS)) & never_last), "phrase")
        .when(is_open & at_limit, "length").when((state == OPEN_AFTER) & (habit >= HABIT), "sentence")
    )


def truncated(documents: DataFrame) -> DataFrame:
    """doc_id, source, truncated, evidence, at_limit of each text that is neither null nor blank; repeated rows each.

    Method: the corpus vocabulary (words with their counts, without the last word of each text) as a trie; a last
    token that is no word but a proper prefix of words is a cut word. That is combined with lengths at which a source's
    texts pile up, with how often the last word ends a sentence, and with whether the text and its source end theirs;
    broken records and cues speak for themselves. Whole texts are read; the vocabulary, the trie, the lengths and the
    habits are tables of any size. A null source is a source of its own."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "kind", "text")
    e = materialize(endings(texts))
    words = last_words(e.where("token is not null"), word_counts(documents.select("text")))
    # Only words that say something meet the texts again: few, and not those many texts end in.
    telling = words.where(F.col("cut") | ((F.col("n") >= SEEN / 4) & (F.col("n_end") < F.col("n") * END_SHARE)))
    words = checked_broadcast(materialize(telling.select("token", "cut", "n", "n_end")))
    no = F.lit(False)
    own_source = F.col("e.source").eqNullSafe(F.col("l.source"))
    # A text without a word to ask for takes its number for a key, which meets nothing, so that such texts do not meet at one place.
    asked = e.withColumn("token", F.coalesce("token", F.concat(F.lit("\u0000"), F.col("doc_id").cast("string")))).join(words, "token", "left")
    joined = (
        asked.alias("e").join(checked_broadcast(length_limits(e)).alias("l"), own_source & (F.col("e.n_chars") == F.col("l.n_chars")), "left")
        .join(checked_broadcast(habits(e)).alias("h"), F.col("e.source").eqNullSafe(F.col("h.source")) & F.col("e.kind").eqNullSafe(F.col("h.kind")), "left")
    )
    at_limit, zero = F.coalesce("at_limit", no), F.lit(0)
    why = evidence(F.col("state"), F.coalesce("cut", no), F.coalesce("n", zero), F.coalesce("n_end", zero), at_limit, F.coalesce("habit", F.lit(0.0)))
    return joined.select("doc_id", "e.source", why.alias("evidence"), at_limit.alias("at_limit")).select("doc_id", "source", F.col("evidence").isNotNull().alias("truncated"), "evidence", "at_limit")


KINDS = ("word", "phrase", "sentence", "length", "mark", "structure")


def by_source(marked: DataFrame) -> DataFrame:
    """How often each source truncates: source, texts, n_truncated, at_limit (how many of those stand where lengths pile up),
    n_word, n_phrase, ... (by the evidence that decided), share."""
    hit = F.count_if("truncated")
    return marked.groupBy("source").agg(
        F.count("*").alias("texts"), hit.alias("n_truncated"), F.count_if(F.col("truncated") & F.col("at_limit")).alias("n_at_limit"),
        *(F.count_if(F.col("evidence").eqNullSafe(k)).alias(f"n_{k}") for k in KINDS), F.round(hit / F.count("*"), 6).alias("share"),
    )
