"""Text as Column expressions: normalisers, number words, sentence and line tools. All of it stays inside the JVM.

The normalisers are separate on purpose: every gate is calibrated on its own. Null texts give null, empty texts empty
lists or strings, unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words numbers are made of.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = "hundred thousand million billion trillion".split()
NUMBER_WORDS = [*ONES, *TENS, *SCALES]
# Characters at which a sentence ends.
SENTENCE_FINAL = '.?!"”)'
DOUBLE_QUOTES = '"“”'
# Signs and what they are in matching; those beyond the second string are removed.
SMART = ("‘’“”–\u00a0\u200b\ufeff", "''\"\"- ")
# Speech mark-up between brackets.
MARKUP = r"\[(?:break|pause)(?::[^\]]*)?\]"


def number_words(n: int) -> list[str] | None:
    """Words of 0 to 9999; None beyond."""
    if not 0 <= n <= 9999:
        return None
    out: list[str] = []
    for unit, name in ((1000, "thousand"), (100, "hundred")):
        if n >= unit:
            out += [ONES[n // unit], name]
            n %= unit
    if n >= 20:
        out.append(TENS[n // 10 - 2])
        n %= 10
    if n or not out:
        out.append(ONES[n])
    return out


def number_words_column(n: Column) -> Column:
    """The words of an integer of 0 to 9999 as one string, null beyond: arithmetic on two small literal arrays."""
    ones, tens = F.array(*map(F.lit, ONES)), F.array(*map(F.lit, TENS))
    none = F.lit(None).cast("string")
    thousand = F.when(n >= 1000, F.concat_ws(" ", F.get(ones, F.floor(n / 1000).cast("int")), F.lit("thousand")))
    hundred = F.when(n % 1000 >= 100, F.concat_ws(" ", F.get(ones, F.floor(n % 1000 / 100).cast("int")), F.lit("hundred")))
    rest = n % 100
    ten = F.when(rest >= 20, F.get(tens, (F.floor(rest / 10) - 2).cast("int")))
    one = F.when(rest < 20, F.when((rest > 0) | (n == 0), F.get(ones, rest.cast("int")))).when(rest % 10 > 0, F.get(ones, (rest % 10).cast("int")))
    return F.when((n >= 0) & (n <= 9999), F.concat_ws(" ", thousand, hundred, ten, one)).otherwise(none)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable, not an expression copied into each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def tokens(text: Column, separators: str = r"[ \t\n\r]+") -> Column:
    """Non-empty parts between separators."""
    return F.filter(F.split(text, separators), lambda w: w != "")


def smart_chars(text: Column) -> Column:
    """Zero-width characters removed, typographic quotes plain, dashes and no-break spaces as used in matching."""
    plain = F.translate(text, *SMART)
    return F.replace(plain, F.lit("—"), F.lit(" - "))


def match_tokens(text: Column) -> Column:
    """Matching tokens: lower case, split at blanks, hyphens and slashes, only a-z and 0-9 kept, numbers of up to four digits as words."""
    raw = F.transform(F.split(F.lower(smart_chars(text)), r"[ \t\n\r/\-]+"), lambda w: F.regexp_replace(w, "[^a-z0-9]", ""))
    words = F.transform(raw, lambda w: F.when(w.rlike("^[0-9]{1,4}$"), F.split(number_words_column(w.cast("int")), " ")).otherwise(F.array(w)))
    return F.filter(F.flatten(words), lambda w: w != "")


def bare_word(word: Column) -> Column:
    """A word with all but a-z and 0-9 deleted."""
    return F.regexp_replace(F.lower(word), "[^a-z0-9]", "")


def cue_tokens(text: Column) -> Column:
    """Hyphens as blanks, only a-z, 0-9, apostrophes kept, split."""
    return tokens(F.regexp_replace(F.replace(F.lower(text), F.lit("-"), F.lit(" ")), r"[^a-z0-9 \t\n\r']", " "))


def coverage_tokens(text: Column) -> Column:
    """All but a-z, 0-9 and blanks deleted, split, numbers and number words dropped."""
    words = tokens(F.regexp_replace(F.lower(text), "[^a-z0-9 ]", ""), " +")
    return F.filter(words, lambda w: ~w.rlike("^[0-9]+$") & ~w.isin(NUMBER_WORDS))


def speech_text(text: Column) -> Column:
    """Mark-up as a blank, everything but a-z and 0-9 as a blank, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), MARKUP, " "), "[^a-z0-9]+", " "))


def strip_markup(text: Column) -> Column:
    """Speech mark-up removed."""
    return squeeze(F.regexp_replace(text, MARKUP, " "))


def heading_tokens(text: Column) -> Column:
    """Without a leading chapter number, lower case, only a-z, 0-9 and blanks, split."""
    bare = F.regexp_replace(text, r"^[ \t]*[0-9IVXLC]+[:.][ \t]*", "")
    return tokens(F.regexp_replace(F.lower(bare), "[^a-z0-9 ]", ""), " +")


def title_key(text: Column) -> Column:
    """N7 for titles: runs of anything but word characters (of any script) as one blank, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\W+", " ")))


def ends_sentence(text: Column) -> Column:
    """The text ends in a sentence-final character."""
    return F.rtrim(text).rlike(r'[.?!"”)]$')


def has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


def expand_digits(text: Column) -> Column:
    """each blank-separated token that is digits with punctuation around them, as number words; others stay."""

    def one(w: Column) -> Column:
        lead, digits, trail = (F.regexp_extract(w, r"^([^0-9A-Za-z]*)([0-9]+)([^0-9A-Za-z]*)$", i) for i in (1, 2, 3))
        words = number_words_column(F.when(F.length(digits) <= 9, digits.cast("int")))
        return F.when((digits != "") & words.isNotNull(), F.concat(lead, words, trail)).otherwise(w)

    return F.array_join(F.transform(F.split(text, " "), one), " ")


def digit_leftovers(text: Column) -> Column:
    """Tokens that still hold a digit after ``expand_digits``."""
    return F.filter(F.split(expand_digits(text), r"[ \t\n\r]+"), lambda w: w.rlike("[0-9]"))


def quote_marks(text: Column) -> Column:
    """Double quotes in a text, straight and typographic."""
    return F.length(text) - F.length(F.translate(text, DOUBLE_QUOTES, ""))


def endnote_marks(text: Column) -> Column:
    """Places where a number stands between a sentence end and a capital."""
    return F.regexp_count(text, F.lit(r"[.!?][ \t\n\r]+[0-9]{1,3}[ \t\n\r]+[A-Z]"))


def sentences(text: Column) -> Column:
    """collapsed text cut after . ! or ? and a blank; null for null, empty list for blank."""
    parts = F.split(squeeze(text), r"(?<=[.!?])[ ]+")
    return F.filter(parts, lambda s: s != "")


def closed_sentences(text: Column) -> Column:
    """runs up to . ! or ? with closing quotes; a tail without an end is dropped."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"""[^.!?]*[.!?]["”’']*\s*"""), F.lit(0)), lambda s: F.trim(s))


def tail_seconds(text: Column, comma: float = 0.2, stop: float = 0.4) -> Column:
    """the pause a text wants after it, from its last sign (one closing quote aside)."""
    bare = F.regexp_replace(F.rtrim(text), "[\"”’']$", "")
    return F.when(bare.rlike("[,;:—-]$"), comma).when(text.isNotNull(), stop)


def seconds_of(stamp: Column) -> Column:
    """F8: seconds of hh:mm:ss.mmm or mm:ss.mmm; null for anything else."""
    ok = stamp.rlike(r"^(?:[0-9]+:)?[0-9]{1,2}:[0-9]{1,2}(?:[.,][0-9]+)?$")
    parts = F.split(F.replace(stamp, F.lit(","), F.lit(".")), ":")
    return F.when(ok, F.aggregate(parts, F.lit(0.0), lambda acc, x: acc * 60 + x.cast("double")))


def stamp_of(seconds: Column) -> Column:
    """F8: hh:mm:ss.mmm, milliseconds rounded half to even, carried over at 1000."""
    ms = F.bround(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def edit_ratio(a: Column, b: Column) -> Column:
    """edit distance over the longer length, both of the lower-case forms (a few are longer than the capital); 1 if either is empty."""
    a, b = F.lower(a), F.lower(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(1.0)).otherwise(F.levenshtein(a, b) / longer)


# What marks a line of a published description as a link, a social label or a plug.
BOILERPLATE = (
    r"(https?://|www\.)|^\s*(become a (youtube |channel )?member|patreon|twitter|twitch|facebook|discord|tiktok|instagram|social media|subscribe( to the email list)?|"
    r"email list|get my book|check out my books?|broadcasted live on twitch|merch|paypal|donate|business inquiries|voicemail)\b"
)
# Fixed value: an episode mark at the end of a title.
EPISODE_MARK = r"\s*(?:[|\-–]\s*)?(?:(?:P(?:ar)?t\.?|Podcast|Episode|Ep\.?|#)\s*\d+[^|]*|P\d+)\s*$"
SHORTS_TAG = r"(?i)\s*#shorts?\b"


def clean_title(title: Column) -> Column:
    """Without #shorts and, until nothing changes, without episode marks at the end; never made empty."""

    def step(t: Column, _: Column) -> Column:
        less = F.regexp_replace(F.regexp_replace(t, "(?i)" + EPISODE_MARK, ""), r"[ |\-–]+$", "")
        return let(less, lambda x: F.when(x == "", t).otherwise(x))

    # Each mark has a number, so a round for each number and one more reach the point where nothing changes.
    rounds = F.sequence(F.lit(0), F.coalesce(F.regexp_count(title, F.lit(r"\d+")), F.lit(0)))
    bare = F.aggregate(rounds, F.regexp_replace(title, SHORTS_TAG, ""), step)
    return F.regexp_replace(bare, r"(?U)^\s+|\s+$", "")


def without_boilerplate(text: Column) -> Column:
    """P5: the lines of a description that are no links, labels or plugs; blank runs collapsed, trimmed."""
    lines = F.transform(F.split(text, r"\r\n|\n|\r"), lambda x: F.regexp_replace(x, r"\s+$", ""))
    kept = F.filter(lines, lambda x: ~x.rlike("(?i)" + BOILERPLATE))
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def without_title_echo(text: Column, title: Column) -> Column:
    """Without a first line that equals, begins or is begun by the title, both normalised."""
    echoes = lambda x: (x["f"] != "") & (x["k"] != "") & (x["f"].startswith(x["k"]) | x["k"].startswith(x["f"]))

    def strip(t: Column) -> Column:
        keys = F.struct(title_key(F.substring_index(t, "\n", 1)).alias("f"), title_key(title).alias("k"))
        rest = F.when(F.contains(t, F.lit("\n")), F.regexp_replace(F.regexp_replace(t, r"^[^\n]*\n", ""), r"^\s+|\s+$", "")).otherwise(F.lit(""))
        return F.when(let(keys, echoes), rest).otherwise(t)

    return let(text, strip)


def clean_description(text: Column, title: Column, most: int | None = None) -> Column:
    """What of a description describes its video. ``most`` characters are kept, if given."""
    clean = without_title_echo(without_boilerplate(text), title)
    return clean if most is None else F.regexp_replace(F.substring(clean, 1, most), r"\s+$", "")


def word_ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` words joined by blanks; an empty list for fewer words (sequence would count down)."""

    def grams(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, runs).when(w.isNotNull(), F.array().cast("array<string>"))

    return let(words, grams)


def pack_sentences(parts: Column, most: int, joiner: int = 1) -> Column:
    """Sentences packed greedily in order to pieces of at most ``most`` characters (a longer sentence is a piece of its own).

    ``joiner`` is what the packer counts for the blank between two sentences."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, s: Column) -> Column:
        fits = (acc["open"] == "") | (F.length(acc["open"]) + joiner + F.length(s) <= most)
        done = F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        now = F.when(acc["open"] == "", s).when(fits, F.concat_ws(" ", acc["open"], s)).otherwise(s)
        return F.struct(done.alias("done"), now.alias("open"))

    return F.aggregate(parts, empty, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"])))


def merge_fragments(parts: Column, least: int = 25) -> Column:
    """I11, default mode: a part shorter than ``least`` characters is joined to the one before it."""

    def step(acc: Column, s: Column) -> Column:
        short = (F.size(acc) > 0) & (F.length(s) < least)
        joined = F.array_append(F.slice(acc, 1, F.size(acc) - 1), F.concat_ws(" ", F.element_at(acc, -1), s))
        return F.when(F.size(acc) == 0, F.array(s)).when(short, joined).otherwise(F.array_append(acc, s))

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def rolling_dedupe(lines: Column) -> Column:
    """Lines without those that equal, or end, the line kept last."""

    def step(acc: Column, line: Column) -> Column:
        known = (F.size(acc) > 0) & F.element_at(acc, -1).endswith(line)
        return F.when(known, acc).otherwise(F.array_append(acc, line))

    return F.aggregate(lines, F.array().cast("array<string>"), step)


def wsl_path(path: Column) -> Column:
    """a path with a drive letter as it is mounted under Linux (/mnt/c/...); others keep all but their backslashes."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    drive = F.regexp_extract(plain, "^([A-Za-z]):", 1)
    return F.when(drive != "", F.concat(F.lit("/mnt/"), F.lower(drive), F.regexp_replace(F.substring(plain, 3, 1 << 30), "^/*", "/"))).otherwise(plain)


def basename(path: Column) -> Column:
    """The last part of a path, without its suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.[^.]*$", "")
