"""Broken prompt and response pairs: a description (the prompt) and the title that answers it (the response)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.wordtrie import last_words, word_counts
from corpusloom.session import checked_broadcast, materialize

# What stands for a missing title, compared without case and outer signs.
STAND_INS = frozenset(
    "untitled|no title|null|nil|nan|n/a|na|tbd|tba|undefined|placeholder|xxx|sin título|sin titulo|sans titre|ohne titel|kein titel|add title here|insert title|your title here".split("|")
)
# Words that do so only in brackets; without them they may be a title.
IN_BRACKETS = frozenset("title|titel|titre|título|titulo|empty|leer|vide|vacío|vacio|none|todo|unknown|unbekannt|inconnu|desconocido|missing|blank|test|default".split("|"))
_BRACKETED = re.compile(r"^\W*[\[(<{].*[\])>}]\W*$", re.S)
# What the words of a refusal say, by class; apostrophes plain, lower case, several languages side by side.
# A refusal says that one who speaks (self) is not (negation) able or allowed (ability) to do what was asked (task, help).
REFUSAL_WORDS = {
    "self": "i|i'm|for me|ich|mir|je|j'ai|m'est|puedo|soy|estoy|no me|я|мне",
    "negation": "not|no|cannot|can't|couldn't|won't|isn't|don't|unable|impossible|nicht|kein|keine|keinen|unmöglich|ne|pas|aucun|aucune|imposible|ningún|ninguna|не|невозможно",
    "ability": "can|could|cannot|can't|couldn't|will|won't|able|unable|possible|impossible|kann|könnte|möglich|unmöglich|in der lage|peux|peut|puis|en mesure|capable|puedo|puede|posible|imposible|capaz|en condiciones|могу|невозможно",
    "allowed": "allowed|permitted|authorized|authorised|darf|befugt|berechtigt|autorisiert|autorisé|autorisée|permis|autorizado|autorizada|permitido",
    "possible": "possible|impossible|möglich|unmöglich|posible|imposible|невозможно",
    "task": "title|titled|titel|titre|título|titulo|request|anfrage|demande|petición|solicitud|guidelines|richtlinien|content policy|text given|this topic|this material|this description|this video|dieses video|"
    "cette vidéo|este vídeo|este video|do for you|for you to title|заголовок|запрос",
    "help": "help|assist|comply|answer|respond|provide|helfen|weiterhelfen|antworten|aider|répondre|ayudar|responder|contestar|помочь|ответить",
    "apology": "sorry|apologize|apologise|unfortunately|regrettably|afraid|leider|bedauerlicherweise|es tut mir leid|malheureusement|désolé|désolée|regrette|lo siento|por desgracia|lamentablemente|desafortunadamente|"
    "lamento|извините|к сожалению",
    "machine": "as an ai|as a language model|as a large language model|as an assistant|i am an ai|i'm an ai|als ki|als sprachmodell|als sprach ki|en tant que modèle|en tant qu'ia|como modelo de lenguaje|como ia|como una ia|"
    "как языковая модель|как ии",
    "request": "request|anfrage|demande|solicitud|petición|запрос",
    "turned_down": "denied|declined|refused|rejected|abgelehnt|verweigert|refusée|rejetée|rechazada|denegada|отклонён|отклонен",
    "decline": "decline|refuse|ablehnen|lehne|verweigere|refuse|refuser|décline|rechazar|rechazo|declino|отказываюсь",
    "done": "suggested|provided|generated|written|created|given|titled|fulfilled|answered|vorgeschlagen|erstellt|vergeben|geschrieben|proposé|donné|fourni|sugerirse|sugerir|darse|proponerse|generarse",
}
# Classes that make a refusal when they stand in one sentence; those after a bar anywhere in the title.
REFUSALS = (
    "self negation ability task", "self negation allowed task", "self negation allowed help", "negation ability|machine", "negation allowed|machine", "self negation ability help|apology",
    "self negation ability possible|apology", "self decline help", "self decline task", "negation ability task done", "negation task possible",
)
_UNSPACED = (("申し訳", "できません"), ("タイトル", "できません"), ("お手伝い", "できません"))
# Frequent words by which a language is told, letters plain lower case.
STOPWORDS = {
    "en": "the of and to in that was with for on a an is had not by were from what why how nobody has been without under behind there they them because when after if who again".split(),
    "de": "der die das und den dem ein eine einen einer mit von zu im ist nicht warum wie aber als auf wenn niemand weil ohne nach vor jeden bei für auch sich hatte wurde zum zur".split(),
    "fr": "le la les de des du et un une dans pour est pas ne que qui avec sur au aux pourquoi comment mais quand sans chaque sous personne car près puis a son sa ses hier était".split(),
    "es": "el la los las de del y un una en que por para con no su es se qué cómo pero cuando sin cada bajo nadie porque cerca luego al lo ayer hacia había".split(),
}
_VOTES: dict[str, tuple[str, ...]] = {}
for _lang, _words in STOPWORDS.items():
    for _w in _words:
        _VOTES[_w] = (*_VOTES.get(_w, ()), _lang)

_WORDS = re.compile(r"\w+(?:['’]\w+)*")
_TAG = re.compile(r"#\w+|@\w+|<[^<>]{0,40}>")
_EPISODE = re.compile(r"(?:\s*[-|–—]\s*|\s*\()(?:part|p|ep\.?|episode|folge|teil|partie|parte)\s*\.?\s*\d+\)?\s*$", re.I)
_QUOTED = re.compile(r"“[^“”]*”|„[^„“”]*[“”]|«[^«»]*»|\"[^\"]*\"|‘[^‘’]*’(?!\w)|「[^「」]*」")
_LABEL = re.compile(r"^\s*(?:title|video|description|titel|titre|título|response|answer|output)\s*[:–-]\s*", re.I)
_DOTS = re.compile(r"(?:…|\.{2,})\s*$")
_HYPHEN = re.compile(r"(?<=\w)[-‐‑](?=\w)")
_SENTENCE = re.compile(r"[^.!?。！？…\n]+[.!?。！？…]*")
_NAMES = ("empty", "truncated", "refusal", "copied", "other_language")

#: Words some match must have (the others one less), share of the title that matches must cover, share of a sentence that must be covered.
SEED, TITLE_SHARE, SENTENCE_SHARE, SENTENCE_WORDS = 3, 0.6, 0.67, 4


def bare_title(title: str) -> str:
    """The title without tags, signs of an episode and invisible characters."""
    t = re.sub("[​-‏⁠﻿­]", "", title)
    t = _TAG.sub(" ", t)
    return _EPISODE.sub("", t.strip()).strip()


def is_empty(title: str | None) -> bool:
    if title is None:
        return True
    t = bare_title(title)
    core = re.sub(r"^[\W_]+|[\W_]+$", "", t).lower()
    if not core or core in STAND_INS or re.sub(r"[^\w/ ]", "", t.lower()).strip() in STAND_INS:
        return True
    return core in IN_BRACKETS and _BRACKETED.match(title) is not None


class PhraseAutomaton:
    """Aho-Corasick automaton over words: which of the labelled phrases end at each word of a sequence."""

    def __init__(self, phrases: dict[str, str]):
        self.next: list[dict[str, int]] = [{}]
        self.says: list[frozenset[str]] = [frozenset()]
        for label, text in phrases.items():
            for p in text.split("|"):
                at = 0
                for w in _WORDS.findall(p):
                    if w not in self.next[at]:
                        self.next[at][w] = len(self.next)
                        self.next.append({})
                        self.says.append(frozenset())
                    at = self.next[at][w]
                self.says[at] |= {label}
        self.fail = [0] * len(self.next)
        queue = list(self.next[0].values())
        for at in queue:
            for w, to in self.next[at].items():
                f = self.fail[at]
                while f and w not in self.next[f]:
                    f = self.fail[f]
                self.fail[to] = self.next[f].get(w, 0) if self.next[f].get(w, 0) != to else 0
                self.says[to] |= self.says[self.fail[to]]
                queue.append(to)

    def run(self, words: list[str]) -> list[frozenset[str]]:
        """For each word the labels of the phrases that end with it."""
        at, out = 0, []
        for w in words:
            while at and w not in self.next[at]:
                at = self.fail[at]
            at = self.next[at].get(w, 0)
            out.append(self.says[at])
        return out


_REFUSAL = PhraseAutomaton(REFUSAL_WORDS)
_RULES = [tuple(frozenset(x.split()) for x in (r + "|").split("|")[:2]) for r in REFUSALS]
_CLAUSE = re.compile(r"[.!?;:…\n]+")
# Without one of these words nothing is declined.
_NEEDED = frozenset(w for k in ("negation", "decline", "turned_down") for p in REFUSAL_WORDS[k].split("|") for w in _WORDS.findall(p))


def is_refusal(title: str) -> bool:
    """Whether the title declines to be one: automaton states over who speaks, negation, ability and what was asked.

    Only what stands outside quotations counts (a title may quote a refusal), unless all of it is quoted. A phrase like
    "I can't" alone is none: it must be about the title, the request or help that was asked for."""
    inner = _QUOTED.sub(" ", title).replace("’", "'").lower()
    text = inner if len(_WORDS.findall(inner)) > 1 else title.replace("’", "'").lower()
    if any(all(x in title for x in both) for both in _UNSPACED):
        return True
    if _NEEDED.isdisjoint(_WORDS.findall(text)):
        return False
    clauses = [_REFUSAL.run(_WORDS.findall(c)) for c in _CLAUSE.split(text)]
    said = [frozenset().union(*c) if c else frozenset() for c in clauses]
    anywhere = frozenset().union(*said)
    if any(here <= s and whole <= anywhere for s in said for here, whole in _RULES):
        return True
    return any("request" in a and ("turned_down" in b or "turned_down" in c) for x in clauses for a, b, c in zip(x, [*x[1:], frozenset()], [*x[2:], frozenset(), frozenset()]))


class SuffixAutomaton:
    """Suffix automaton of a sequence of words, with the end of the first occurrence of each state."""

    def __init__(self, words: list[str]):
        nxt: list[dict[str, int]] = [{}]
        link, length, first = [-1], [0], [-1]
        last = 0
        for i, w in enumerate(words):
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            first.append(i)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    first.append(first[q])
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.nxt, self.link, self.length, self.first = nxt, link, length, first

    def matches(self, words: list[str], least: int) -> list[tuple[int, int, int]]:
        """(start in ``words``, start in the text, length) of the longest matches, greedily from the left."""
        ends, at, n = [], 0, 0
        for w in words:  # matching statistics: the longest match that ends here
            while at and w not in self.nxt[at]:
                at = self.link[at]
                n = self.length[at]
            if w in self.nxt[at]:
                at = self.nxt[at][w]
                n += 1
            ends.append((n, self.first[at]))
        out, i = [], len(words) - 1
        while i >= 0:
            n, first = ends[i]
            if n >= least:
                out.append((i - n + 1, first - n + 1, n))
                i -= n
            else:
                i -= 1
        return out[::-1]


def _flat(text: str) -> str:
    """Letter case, apostrophes and hyphens inside words aside."""
    text = text.replace("’", "'").casefold()
    return _HYPHEN.sub("", text) if "-" in text or not text.isascii() else text


def _is_prose(line: str) -> bool:
    """A sentence rather than a heading: several words and a full stop (dots after a heading are none)."""
    return len(line.split()) > 5 and bool(re.search(r"(?<!\.)[.!?][\"”»]*\s*$", line))


_UNITS = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W\u3040-\u30ff\u3400-\u9fff]+(?:['’]\w+)*")


def _words(text: str) -> list[str]:
    """Words; of scripts without blanks each character is one."""
    return _WORDS.findall(text) if text.isascii() else _UNITS.findall(text)


def copied(title: str, description: str) -> bool:
    """Whether the title repeats one or more whole sentences of the description, verbatim or nearly.

    A first line that only echoes a title is not counted. The title is run through the suffix automaton of the
    description; it is a copy if one match has SEED words or more and matches of SEED - 1 or more cover TITLE_SHARE of it
    and SENTENCE_SHARE of a sentence."""
    words = _words(_flat(_LABEL.sub("", title)))
    if len(words) < SENTENCE_WORDS:
        return False
    text = description.replace("\r", "")
    head, _, rest = text.partition("\n")
    if rest and not _is_prose(head) and _WORDS.findall(bare_title(head).lower()) == _WORDS.findall(bare_title(title).lower()):
        text = rest
    text = _flat(text)
    if sum(w in text for w in words) < TITLE_SHARE * len(words):
        return False  # too few of its words stand there at all
    flat = " ".join(_words(text))
    if not any(" ".join(words[i : i + SEED]) in flat for i in range(len(words) - SEED + 1)):
        return False
    bounds, all_words = [], []
    for m in _SENTENCE.finditer(text):
        w = _words(m[0])
        if w:
            bounds.append((len(all_words), len(all_words) + len(w)))
            all_words += w
    runs = SuffixAutomaton(all_words).matches(words, SEED - 1)
    if sum(n for *_, n in runs) < TITLE_SHARE * len(words):
        return False
    hit = set()
    for _, start, n in runs:
        hit.update(range(start, start + n))
    return any(b - a >= SENTENCE_WORDS and sum(i in hit for i in range(a, b)) >= SENTENCE_SHARE * (b - a) for a, b in bounds)


def votes(text: str) -> dict[str, int]:
    """Stopword votes by language."""
    out = {"en": 0, "de": 0, "fr": 0, "es": 0}
    get = _VOTES.get
    for w in text.lower().replace("?", " ").replace(",", " ").split():
        for lang in get(w, ()):
            out[lang] += 1
    return out


_CYRILLIC, _CJK, _LATIN = re.compile("[\u0400-\u052f]"), re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]"), re.compile("[A-Za-z\u00c0-\u024f]")
_FOREIGN = re.compile(f"{_CYRILLIC.pattern}|{_CJK.pattern}")


def _script(text: str) -> str:
    n = {"latin": len(_LATIN.findall(text)), "cyrillic": len(_CYRILLIC.findall(text)), "cjk": len(_CJK.findall(text))}
    return max(n, key=n.get) if any(n.values()) else ""


def other_language(title: str, description: str) -> bool:
    """Stopword votes (and scripts) of the title outside quotations against those of the description."""
    t = bare_title(_QUOTED.sub(" ", title))
    if _FOREIGN.search(t) or _FOREIGN.search(description):
        a, b = _script(t), _script(description)
        if a and b and a != b:
            return len(re.findall(r"[^\W\d_]", t)) >= 4
    v = votes(t)
    best = max(v, key=v.get)
    if v[best] < 1:
        return False
    d = votes(description)
    own = max(d, key=d.get)
    if own == best or d[own] == 0 or d[own] <= d[best]:
        return False
    return v[best] - v[own] >= 2 or (v[own] == 0 and v[best] >= 1 and len(t.split()) <= 5)


def unclosed(title: str) -> bool:
    """A delimiter stack: is a bracket or quotation opened and never closed? Straight quotes and apostrophes are left out."""
    closes, stack = {")": "(", "]": "[", "”": "“", "»": "«", "」": "「"}, []
    for c in title.replace("„", "“") if "“" not in title or "„" not in title else title.replace("“", "”").replace("„", "“"):
        if c in "([“«「":
            stack.append(c)
        elif c in closes and stack and stack[-1] == closes[c]:
            stack.pop()
    return bool(stack)


def last_token(title: str) -> str:
    t = _DOTS.sub("", bare_title(title)).rstrip()
    words = _WORDS.findall(t.lower())
    return words[-1] if words and t.lower().endswith(words[-1]) else ""


FEATURES = "verdict_id long, defect string, token string"


def inspect(title: str | None, description: str) -> tuple[str | None, str]:
    """(defect, last token): the first defect of one pair that needs no corpus, else the token the corpus is asked for."""
    if is_empty(title):
        return "empty", ""
    if is_refusal(title):
        return "refusal", ""
    if copied(title, description):
        return "copied", ""
    if other_language(title, description):
        return "other_language", ""
    if unclosed(title):
        return "truncated", ""
    return None, last_token(title)


#: A word ends no title if it stands in this many and is last in less than this share of them.
SEEN, LAST_SHARE = 30, 0.03


def pair_texts(verdicts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """verdict_id, title (the last one), description of each pair whose description is neither null nor blank."""
    d = descriptions.select("video_id", F.col("snippet.description").alias("description")).where(F.col("description").rlike(r"(?U)\S"))
    v = verdicts.select("verdict_id", "video_id", F.try_element_at("titles", F.lit(-1)).alias("title"))
    return v.join(d, "video_id").select("verdict_id", "title", "description")


def defective_pairs(verdicts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """verdict_id and defect of each defective pair: one row per row of ``verdicts``, the first that holds of empty,
    refusal, copied, other_language, truncated. Re-delivered rows count each; pairs without a description are none.
    A null list, an empty one or a null last element is an empty title. Texts are read whole.

    Method: a suffix automaton of the prompt measures what the title copies of it; an automaton of refusal phrases,
    delimiter stacks and stopword votes tell the others; what is cut inside a word or phrase, the vocabulary of all
    titles as a trie (a last word that is only a proper prefix of words, or one that ends no title)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            rows = [inspect(t, d) for t, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["verdict_id", "defect", "token"])

    pairs = pair_texts(verdicts, descriptions).withColumn("verdict_id", F.col("verdict_id").cast("long"))
    found = materialize(pairs.mapInArrow(run, FEATURES))
    titles = verdicts.select(F.explode("titles").alias("title")).select(_without_tail(F.col("title")).alias("title"))
    counts = word_counts(titles.groupBy(F.lower("title").alias("title")).agg(F.count("*").alias("times")), drop_last=False)
    words = last_words(found.where(F.col("defect").isNull()), counts)
    n_last = F.coalesce("n_last", F.lit(0))
    total = F.coalesce("n", F.lit(0)) + n_last
    never_last = (total >= SEEN) & (n_last < total * LAST_SHARE)
    # Only the words a title cannot end in meet the titles again: few, and none of those most titles end in.
    bad = checked_broadcast(materialize(words.where(F.col("cut") | never_last).select("token", F.lit("truncated").alias("broke"))))
    asked = found.where(F.col("defect").isNull() & (F.col("token") != "")).join(bad, "token").select("verdict_id", F.col("broke").alias("defect"))
    return found.where(F.col("defect").isNotNull()).select("verdict_id", "defect").unionByName(asked)


def _without_tail(title: Column) -> Column:
    """The title without tags, dots and the like, so that its last word is last."""
    t = F.regexp_replace(title, r"#\w+", " ")
    t = F.regexp_replace(t, r"(?i)(\s*[-|–—]\s*|\s*\()(part|p|ep\.?|episode|folge|teil|partie|parte)\s*\.?\s*\d+\)?\s*$", "")
    return F.regexp_replace(F.trim(t), r"[\s.…!?]+$", "")
