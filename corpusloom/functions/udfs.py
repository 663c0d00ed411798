"""Arrow UDFs for what no built-in says exactly: HTML text, sequence similarity, callback replacements."""

from __future__ import annotations

import difflib
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import number_words

# Elements whose content is no text, and those after whose end a line ends.
SKIPPED, BREAKING, HEADINGS = frozenset(("script", "style", "sup")), frozenset(("p", "div", "h1", "h2", "h3", "br", "li")), frozenset(("h1", "h2", "h3"))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.headings, self.deep, self.heading = [], [], 0, None

    def handle_starttag(self, tag, attrs):
        self.deep += tag in SKIPPED
        if tag in HEADINGS:
            self.heading = []

    def handle_endtag(self, tag):
        if tag in SKIPPED and self.deep:
            self.deep -= 1
        if tag in BREAKING:
            self.out.append("\n")
        if tag in HEADINGS and self.heading is not None:
            self.headings.append(" ".join("".join(self.heading).split()))
            self.heading = None

    def handle_data(self, data):
        if not self.deep:
            self.out.append(data)
            if self.heading is not None:
                self.heading.append(data)


def html_parts(html: str) -> tuple[str, list[str]]:
    """(text, headings): a line ends where a block ends; script, style and sup are left out; entities decoded."""
    p = _Text()
    p.feed(html)
    p.close()
    return "".join(p.out), [h for h in p.headings if h]


@F.arrow_udf(T.StringType())
def html_text(a: pa.Array) -> pa.Array:
    return pa.array([None if x is None else html_parts(x)[0] for x in a.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def html_headings(a: pa.Array) -> pa.Array:
    return pa.array([None if x is None else html_parts(x)[1] for x in a.to_pylist()], pa.list_(pa.string()))


def ratio(a, b, autojunk: bool = False) -> float:
    """Ratcliff-Obershelp similarity of two sequences."""
    return difflib.SequenceMatcher(None, a, b, autojunk=autojunk).ratio()


def same_characters(a: str, b: str) -> int:
    """Characters in Ratcliff-Obershelp's blocks of two texts: the longest common piece, the first in ``a`` and then in ``b``
    on ties, and the same to its left and right. Pieces are looked up by the string search instead of cell by cell."""
    total, todo = 0, [(a, b)]
    while todo:
        a, b = todo.pop()
        n, most = len(a), len(b)
        if n == 1 or most == 1:
            total += a in b if n == 1 else b in a
            continue
        i = size = at = 0
        while i + size < n and size < most:
            if a[i : i + size + 1] in b:
                size, at = size + 1, i
            else:
                i += 1
        if size:
            total += size
            j = b.find(a[at : at + size])
            if at and j:
                todo.append((a[:at], b[:j]))
            if at + size < len(a) and j + size < len(b):
                todo.append((a[at + size :], b[j + size :]))
    return total


def text_ratio(a: Column, b: Column) -> Column:
    """F11 on characters, no junk heuristic; null if either is null."""

    def ratio(p: str, q: str) -> float:
        return 2.0 * same_characters(p, q) / (len(p) + len(q)) if p or q else 1.0

    @F.arrow_udf(T.DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if p is None or q is None else ratio(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return run(a, b)


def token_ratio(a: Column, b: Column, autojunk: bool = True) -> Column:
    """F11 on token lists."""

    @F.arrow_udf(T.DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if p is None or q is None else ratio(p, q, autojunk) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return run(a, b)


def longest_common(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``b``."""
    at: dict = {}
    for i, w in enumerate(b):
        at[w] = at.get(w, 0) | 1 << i
    mask = (1 << len(b)) - 1
    v = mask
    for w in a:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & mask
    return (v ^ mask).bit_count()


def lcs_length(a: Column, b: Column) -> Column:
    """F10 on token lists; null if either is null."""

    @F.arrow_udf(T.IntegerType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if p is None or q is None else longest_common(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.int32())

    return run(a, b)


def lcs_words(a: Column, b: Column) -> Column:
    """F10 on texts of words with blanks between them; null if either is null. Texts travel as strings; one that stands in
    many pairs is taken apart once a batch, and a pair is counted once however often it stands there."""

    @F.arrow_udf(T.IntegerType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        words: dict[str, list[str]] = {}
        known: dict[tuple[str, str], int] = {}

        def length(p: str, q: str) -> int:
            got = known.get((p, q))
            if got is None:
                for t in (p, q):
                    if t not in words:
                        words[t] = t.split()
                got = known[p, q] = longest_common(words[p], words[q])
            return got

        return pa.array([None if p is None or q is None else length(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.int32())

    return run(a, b)


def _spoken(digits: str) -> str:
    words = number_words(int(digits)) if len(digits) <= 4 else None
    return " ".join(words) if words else digits


_BOOK = re.compile(r"\b([123]) (?=[A-Z][a-z])")
_VERSE = re.compile(r"(\d+):(\d+)(?:[–-](\d+))?(?:ff\.)?")
_BOOK_ORDINAL = {"1": "First ", "2": "Second ", "3": "Third "}


def spoken_scripture(text: str) -> str:
    """'1 John 1:9' as 'First John one nine', '5:16-18' as 'five sixteen through eighteen'. Runs before digits are expanded."""
    text = _BOOK.sub(lambda m: _BOOK_ORDINAL[m[1]], text)
    return _VERSE.sub(lambda m: " ".join([_spoken(m[1]), _spoken(m[2]), *(("through", _spoken(m[3])) if m[3] else ())]), text)


# Names of popes, which take numerals and number words, and names that take numerals only.
POPES = "Pius Leo Benedict Gregory Innocent Clement Urban Boniface Alexander Sixtus Honorius Celestine Nicholas Adrian Hadrian Callixtus Eugene".split()
OTHER_NAMES = "John Paul Stephen".split()
_ORDINALS = "First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Eleventh Twelfth Thirteenth Fourteenth Fifteenth Sixteenth Seventeenth Eighteenth Nineteenth Twentieth".split()


def _regnal_numbers() -> tuple[dict[str, str], dict[str, str]]:
    """Roman numerals and number words of 2 to 25, with their ordinals."""
    roman, words = {}, {}
    for n in range(2, 26):
        tens, one = divmod(n, 10)
        numeral = "X" * tens + ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"][one]
        ordinal = _ORDINALS[n - 1] if n <= 20 else f"Twenty-{_ORDINALS[n - 21]}"
        roman[numeral] = ordinal
        words["-".join(number_words(n))] = ordinal
    return roman, words


_ROMAN, _CARDINAL = _regnal_numbers()
_alternatives = lambda xs: "|".join(sorted(xs, key=len, reverse=True))
_POPE = re.compile(rf"\b({_alternatives(POPES)})\s+(?:the\s+)?({_alternatives([*_ROMAN, *_CARDINAL])})\b")
_NAME = re.compile(rf"\b({_alternatives(OTHER_NAMES)})\s+(?:the\s+)?({_alternatives(_ROMAN)})\b")


def regnal_names(text: str) -> tuple[str, int]:
    """(text with 'Pius XII' as 'Pius the Twelfth', how many places changed)."""
    changed = 0

    def say(m: re.Match) -> str:
        nonlocal changed
        new = f"{m[1]} the {(_ROMAN | _CARDINAL)[m[2]]}"
        changed += new != m[0]
        return new

    return _NAME.sub(say, _POPE.sub(say, text)), changed


@F.arrow_udf(T.StringType())
def scripture(a: pa.Array) -> pa.Array:
    return pa.array([None if x is None else spoken_scripture(x) for x in a.to_pylist()], pa.string())


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("changed", T.IntegerType())]))
def regnal(a: pa.Array) -> pa.Array:
    rows = [(None, None) if x is None else regnal_names(x) for x in a.to_pylist()]
    return pa.array([{"text": t, "changed": n} for t, n in rows], pa.struct([("text", pa.string()), ("changed", pa.int32())]))


def word_error_rate(want: list[str], got: list[str]) -> float:
    """Word edit distance over the length of the reference; 0 for two empty texts, 1 for an empty reference."""
    if not want:
        return float(bool(got))
    row = list(range(len(got) + 1))
    for i, w in enumerate(want, 1):
        left, row[0] = row[0], i
        for j, g in enumerate(got, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (w != g))
    return row[-1] / len(want)


def wer(want: Column, got: Column) -> Column:
    @F.arrow_udf(T.DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if p is None or q is None else word_error_rate(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return run(want, got)
