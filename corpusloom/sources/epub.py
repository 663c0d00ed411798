"""EPUB books as rows: one per spine document, then one per word with its spine index and offset."""

from __future__ import annotations

import io
import posixpath
import zipfile
from urllib.parse import unquote
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.udfs import html_parts

_BOOK = "path string, spine_idx int, file string, heading string, text string"


def spine(content: bytes) -> list[tuple[int, str, str]]:
    """(index, file, html) in reading order; a member that is missing has an empty text."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        local = lambda e: e.tag.rsplit("}", 1)[-1]
        root = ElementTree.fromstring(z.read("META-INF/container.xml"))
        opf = next(e.get("full-path") for e in root.iter() if local(e) == "rootfile")
        package = ElementTree.fromstring(z.read(opf))
        items = {e.get("id"): e.get("href") for e in package.iter() if local(e) == "item"}
        names, out = set(z.namelist()), []
        for e in package.iter():
            if local(e) == "itemref" and e.get("idref") in items:
                name = posixpath.normpath(posixpath.join(posixpath.dirname(opf), unquote(items[e.get("idref")])))
                out.append((len(out), name, z.read(name).decode("utf-8", "ignore") if name in names else ""))
    return out


def by_name(content: bytes) -> list[tuple[int, str, str]]:
    """All HTML members sorted by name."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
        return [(i, n, z.read(n).decode("utf-8", "ignore")) for i, n in enumerate(names)]


def read_books(spark: SparkSession, path: str, order: str = "spine") -> DataFrame:
    """Path, spine_idx, file, heading (the first h1 to h3), text of each document of each book."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                rows = []
                for i, file, html in (spine if order == "spine" else by_name)(bytes(content)):
                    text, heads = html_parts(html)
                    rows.append((p, i, file, heads[0] if heads else None, text))
                yield pd.DataFrame(rows, columns=["path", "spine_idx", "file", "heading", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, _BOOK)


def words(books: DataFrame) -> DataFrame:
    """path, spine_idx, pos (in its document), word, char_off (running within the document)."""
    parts = F.transform(F.regexp_extract_all("text", F.lit(r"(\s*)(\S+)"), F.lit(0)), lambda w: F.struct(w.alias("raw"), F.regexp_replace(w, r"\s+", "").alias("word")))
    with_off = F.transform(parts, lambda p, i: F.struct(p["word"].alias("word"), (F.aggregate(F.slice(parts, 1, i + 1), F.lit(0), lambda a, x: a + F.length(x["raw"])) - F.length(p["word"])).alias("char_off")))
    return books.select("path", "spine_idx", F.posexplode(with_off).alias("pos", "w")).select("path", "spine_idx", "pos", "w.word", "w.char_off")


def glossary_text(books: DataFrame) -> DataFrame:
    """Path, text: all documents in order, white space collapsed."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("spine_idx", "text"))), lambda x: x["text"])
    return books.groupBy("path").agg(F.trim(F.regexp_replace(F.array_join(ordered, " "), r"\s+", " ")).alias("text"))
