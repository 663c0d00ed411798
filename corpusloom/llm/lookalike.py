"""Visually identical text with different characters: one consistent spelling, repaired token by token.

The dominant script of a token is that of its letters that look like no letter of the other script. In a token of two
scripts the look-alikes of the others are replaced by letters of the dominant one, where the result is a word of the
corpus; where it is none, a Latin token is found and reported, but left as it is.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checked_broadcast, materialize

# Letters of other scripts that look like Latin ones (a part of the public Unicode confusables data).
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһӏ", "ABESIJKMHOPCTYXaesijopcyxdqwhl"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανοιυρκ", "ABEZHIKMNOPTYXavoiupk"))
ARMENIAN = dict(zip("օոսցհՕՍ", "onughOU"))
LISU = dict(zip("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFNLSRVHWXYAEIOU"))
CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiYAJEWMHYGhZbRWSVSLCPKdGB"))
CONFUSABLES = CYRILLIC | dict(zip("Ԍԍ", "Gg")) | GREEK | ARMENIAN | LISU | CHEROKEE
# The other way round, for a Latin letter inside a word of such a script.
BACK = {"cyrillic": {b: a for a, b in CYRILLIC.items()}, "greek": {b: a for a, b in GREEK.items()}}
# Latin letters in a mathematical type face, by their decompositions.
STYLED = {chr(o): d[-1] for o in range(0x1D400, 0x1D6A4) if (d := [chr(int(x, 16)) for x in unicodedata.decomposition(chr(o)).split()[1:]])}

# Invisible characters: format characters, the soft hyphen, the combining grapheme joiner, variation selectors, Hangul fillers.
_INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0"
# Spaces other than the plain one; line breaks stay. The tab is white space of layout and stays as well.
_SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
# Width variants, ligatures, Roman numerals and the like: characters that stand for plain ones.
_COMPAT = "\u0132\u0133\u01c4-\u01cc\u01f1-\u01f3\u2160-\u217f\ufb00-\ufb06\ufb13-\ufb17\uff01-\uff5e\uff61-\uff9f\uffe0-\uffe6"
_MARKS = "\u0300-\u036f\u3099\u309a"
#: What may need repair, for a filter inside the JVM: the above, and any letter of the scripts with look-alikes.
SUSPECT = f"[{_INVISIBLE}{_SPACES}{_COMPAT}{_MARKS}\u0370-\u058f\u13a0-\u13ff\ua4d0-\ua4ff\U0001d400-\U0001d6a3]"

_suspect = re.compile(SUSPECT)
_invisible, _spaces = re.compile(f"[{_INVISIBLE}]"), re.compile(f"[{_SPACES}]")
_compat, _marked = re.compile(f"[{_COMPAT}]+"), re.compile(f"[^{_MARKS}][{_MARKS}]+")
_token = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_joined_emoji = re.compile("[\U0001f000-\U0001faff\u2600-\u27bf\ufe0f\u200d\U0001f3fb-\U0001f3ff]{2,}")


def script(ch: str) -> str:
    """A coarse script name of a letter."""
    o = ord(ch)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "latin"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    return unicodedata.name(ch, "other").split(" ")[0].lower()


def compose(text: str) -> str:
    """Letters joined with their accents; width variants, ligatures and numerals as plain characters; plain spaces;
    nothing invisible (but within joined emoji and flags)."""
    if _invisible.search(text):
        keep = [m.span() for m in _joined_emoji.finditer(text)]
        text = "".join(
            c for i, c in enumerate(text) if not _invisible.match(c) or (c in "\u200d\ufe0f" and any(a <= i < b for a, b in keep))
        ) if keep else _invisible.sub("", text)
    text = _spaces.sub(" ", text)
    text = _compat.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    return _marked.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)


def dominant(token: str) -> str:
    """The script of most letters of the token that look like no letter of another script; Latin on ties."""
    votes: dict[str, int] = {"latin": 0}
    for c in token:
        s = script(c)
        if c.isalpha() and c not in CONFUSABLES and c not in STYLED and not (s == "latin" and any(c in back for back in BACK.values())):
            votes[s] = votes.get(s, 0) + 1
    return max(votes, key=lambda s: (votes[s], s == "latin"))


def one_script(token: str) -> tuple[str, str] | None:
    """(dominant script, the token in it alone) of a token of several scripts whose letters of the others all look like
    letters of it; else None. A single letter is a sign of its own, not a word."""
    letters = [c for c in token if c.isalpha()]
    if len(letters) < 2 or (len({script(c) for c in letters}) < 2 and not any(c in STYLED for c in letters)):
        return None
    own = dominant(token)
    alike = CONFUSABLES | STYLED if own == "latin" else BACK.get(own)
    if alike is None:
        return None
    fixed = "".join(c if script(c) == own and c not in STYLED else alike.get(c, c) for c in token)
    return (own, fixed) if fixed != token and all(script(c) == own for c in fixed if c.isalpha()) else None


def mixed_tokens(text: str) -> list[tuple[str, str, bool]]:
    """(token, repaired, Latin) of each mixed token of a composed text."""
    if text.isascii():
        return []
    found = [(m[0], one_script(m[0])) for m in _token.finditer(text)]
    return [(t, x[1], x[0] == "latin") for t, x in found if x]


def with_tokens(text: str, repairs: dict[str, str]) -> str:
    """A composed text with the given tokens replaced."""
    return _token.sub(lambda m: repairs.get(m[0], m[0]), text) if repairs else text


def canonical(text: str) -> str:
    """The one consistent spelling of a text, for comparisons: Latin tokens are repaired without a look at the corpus."""
    if text.isascii() or not _suspect.search(text):
        return text
    text = compose(text)
    return with_tokens(text, {t: fixed for t, fixed, latin in mixed_tokens(text) if latin})


COMPOSED = "tbl string, row_id long, text string, composed string, tokens array<struct<token:string,repaired:string,latin:boolean>>"


def suspects(df: DataFrame, tbl: str, row_id: str, text: str) -> DataFrame:
    return df.select(F.lit(tbl).alias("tbl"), F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("text")).where(
        (F.octet_length("text") != F.char_length("text")) & F.col("text").rlike(SUSPECT)  # plain ASCII is not searched
    )


def composed_rows(suspicious: DataFrame) -> DataFrame:
    """tbl, row_id, text, composed, tokens (mixed ones, their repair and whether it is Latin) of the rows that have something to change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("token", pa.string()), ("repaired", pa.string()), ("latin", pa.bool_())]))
        for batch in batches:
            out = []
            for tbl, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                plain = compose(text)
                tokens = mixed_tokens(plain)
                if tokens or plain != text:
                    out.append((tbl, row, text, plain, [{"token": a, "repaired": b, "latin": c} for a, b, c in tokens]))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["tbl", "row_id", "text", "composed", "tokens"])

    return suspicious.mapInArrow(run, COMPOSED)


def vocabulary_hits(texts: list[DataFrame], tokens: DataFrame) -> DataFrame:
    """(repaired) of ``tokens`` that stand as words somewhere in ``texts`` (one column, text), letter case aside."""
    wanted = checked_broadcast(materialize(tokens.select(F.lower("repaired").alias("repaired")).distinct()))
    words = None
    for df in texts:
        w = df.select(F.explode(F.split(F.lower("text"), r"[^\p{L}'’]+")).alias("repaired"))
        words = w if words is None else words.unionByName(w)
    return words.join(wanted, "repaired", "left_semi").distinct()


Tables = list[tuple[str, DataFrame, str, str]]


def _changes(tables: Tables) -> DataFrame:
    found = None
    for tbl, df, row_id, text in tables:
        s = suspects(df, tbl, row_id, text)
        found = s if found is None else found.unionByName(s)
    return composed_rows(found)


def _known(tables: Tables, tokens: DataFrame) -> DataFrame:
    """The rows (repaired) of ``tokens`` that are words of the tables, in lower case, with known = true."""
    hits = vocabulary_hits([df.select(F.col(text).alias("text")) for _, df, _, text in tables], tokens)
    return checked_broadcast(materialize(hits)).withColumn("known", F.lit(True))


def found_rows(tables: Tables) -> DataFrame:
    """tbl, row_id of the rows with characters to replace or remove, repeated rows each.

    What is composed anew is a case, and so is each token with Latin as its dominant script that look-alikes of others
    stand in, whether the corpus knows its repair or not. A token of another script with Latin letters in it is one only
    if its repair is a word of the corpus; the tables are read for their words only if there is such a token alone."""
    changed = _changes(tables)
    sure = (F.col("text") != F.col("composed")) | F.exists("tokens", lambda t: t["latin"])
    rows = materialize(changed.select("tbl", "row_id", sure.alias("sure"), F.when(~sure, F.col("tokens.repaired")).alias("ask")))
    out = rows.where("sure").select("tbl", "row_id")
    ask = rows.where("not sure").select("tbl", "row_id", F.monotonically_increasing_id().alias("i"), "ask")
    if ask.limit(1).count() == 0:
        return out
    ask = materialize(ask)
    tokens = ask.select("tbl", "row_id", "i", F.explode("ask").alias("repaired"))
    hits = tokens.withColumn("repaired", F.lower("repaired")).join(_known(tables, tokens), "repaired", "left_semi")
    return out.unionByName(hits.select("tbl", "row_id", "i").distinct().select("tbl", "row_id"))


def normalize(tables: Tables) -> DataFrame:
    """The rows of the given (tbl, table, id column, text column) that hold characters to replace or remove.

    Returns tbl, row_id, text, repaired, confirmed, unconfirmed. Accents, widths, spaces and invisible characters are
    always made plain. A token of two scripts is repaired if the result, in its dominant script, is a word of the
    corpus (``confirmed`` counts those places); a Latin one whose repair the corpus does not know is left as it is and
    counted as ``unconfirmed``. Null and empty texts and rows without a case are left out; repeated rows come out each.
    Texts are read whole; only suspicious rows leave the JVM.

    Words wholly in another script, composed accents, typographic quotes and dashes, and signs with a meaning of
    their own are left alone."""
    changed = materialize(_changes(tables).withColumn("h", F.xxhash64("text")))
    key = ["tbl", "row_id", "h"]
    tokens = changed.select(*key, "tokens").dropDuplicates(key).select(*key, F.explode("tokens").alias("t")).select(*key, "t.*")
    marked = tokens.withColumn("_low", F.lower("repaired")).join(_known(tables, tokens).withColumnRenamed("repaired", "_low"), "_low", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    per = marked.groupBy(*key).agg(
        F.collect_set(F.when(F.col("known"), F.struct("token", "repaired"))).alias("good"), F.count_if("known").alias("confirmed"), F.count_if(~F.col("known") & F.col("latin")).alias("unconfirmed")
    )  # of one text, so bounded by its words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = [with_tokens(c, {x["token"]: x["repaired"] for x in g or ()}) for c, g in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fixed, pa.string()), *batch.columns[5:]], names=["tbl", "row_id", "text", "repaired", "confirmed", "unconfirmed"])

    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = changed.join(per, key, "left").select("tbl", "row_id", "text", "composed", "good", zero("confirmed"), zero("unconfirmed"))
    out = rows.mapInArrow(run, "tbl string, row_id long, text string, repaired string, confirmed long, unconfirmed long")
    return out.where("text <> repaired or unconfirmed > 0")


def canonical_column(text: Column) -> Column:
    """``canonical`` as a Column; ASCII texts are passed through inside the JVM's filter by the caller."""

    @F.arrow_udf("string")
    def apply(a: pa.Array) -> pa.Array:
        return pa.array([None if t is None else canonical(t) for t in a.to_pylist()], pa.string())

    return apply(text)
