"""Compressed citation files as rows, one per change, in document order.

Spark lists and reads the files as binary, from any file system that it knows; each is then scanned element by element.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "basename string, ordinal bigint, op string, pmid bigint, title string, abstract string, year int, journal string, problem string"
_ARROW = pa.schema([("basename", pa.string()), ("ordinal", pa.int64()), ("op", pa.string()), ("pmid", pa.int64()), ("title", pa.string()), ("abstract", pa.string()), ("year", pa.int32()), ("journal", pa.string()), ("problem", pa.string())])
_YEAR = re.compile(r"\b(?:19|20)\d{2}\b")
CORRUPT = (gzip.BadGzipFile, EOFError, zlib.error, ElementTree.ParseError)


def _name(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _child(e: ElementTree.Element | None, *path: str) -> ElementTree.Element | None:
    """The first direct child of each name in turn."""
    for name in path:
        e = next((c for c in e if _name(c) == name), None) if e is not None else None
    return e


def _full_text(e: ElementTree.Element | None) -> str | None:
    return ("".join(e.itertext()).strip() or None) if e is not None else None


def _whole(text: str | None) -> int | None:
    try:
        return int((text or "").strip())
    except ValueError:
        return None


def _year(citation: ElementTree.Element, article: ElementTree.Element) -> int | None:
    date = _child(article, "Journal", "JournalIssue", "PubDate")
    own = lambda e: e.text if e is not None else None
    year = _whole(own(_child(date, "Year")))
    if year is None and (m := _YEAR.search(_full_text(_child(date, "MedlineDate")) or "")):
        year = int(m[0])
    for place in (_child(article, "ArticleDate", "Year"), _child(citation, "DateCompleted", "Year")):
        if year is None:
            year = _whole(own(place))
    return year


def _abstract(article: ElementTree.Element) -> str | None:
    parts, whole = [], _child(article, "Abstract")
    for e in whole if whole is not None else ():
        if _name(e) == "AbstractText":
            body, label = _full_text(e) or "", e.get("Label")
            text = f"{label}: {body}".strip() if label else body
            if text:
                parts.append(text)
    return "\n\n".join(parts) or None


def record(element: ElementTree.Element) -> tuple | None:
    """pmid, title, abstract, year, journal of a PubmedArticle; None without a whole-number id or an article."""
    citation = _child(element, "MedlineCitation")
    pmid, article = _whole(_full_text(_child(citation, "PMID"))), _child(citation, "Article")
    if pmid is None or article is None:
        return None
    return pmid, _full_text(_child(article, "ArticleTitle")), _abstract(article), _year(citation, article), _full_text(_child(article, "Journal", "Title"))


def changes_in(file: BinaryIO | str, delete_scope: str = "first", name: str | None = None) -> Iterator[tuple]:
    """basename, ordinal, op, pmid, fields and no problem of one compressed file, given by path or open. A delete removes
    its first id only, or with "all" every one."""
    base, ordinal = name or str(file).rpartition("/")[2], 0
    with gzip.open(file, "rb") as f:
        for _, e in ElementTree.iterparse(f, events=("end",)):
            tag = _name(e)
            if tag == "PubmedArticle":
                if row := record(e):
                    yield base, ordinal, "update", *row, None
                    ordinal += 1
                e.clear()
            elif tag == "DeleteCitation":
                ids = [_whole(_full_text(c)) for c in e if _name(c) == "PMID"]
                for pmid in ids[:1] if delete_scope == "first" else ids:
                    if pmid is not None:
                        yield base, ordinal, "delete", pmid, None, None, None, None, None
                        ordinal += 1
                e.clear()


def parsed(files: DataFrame, *, delete_scope: str = "first", on_corrupt: str = "fail") -> DataFrame:
    """The changes in files, given as basename and content (compressed). With on_corrupt="quarantine" a corrupt file gives
    one row with the problem and none of its changes. A null content gives no row."""
    if delete_scope not in ("first", "all") or on_corrupt not in ("fail", "quarantine"):
        raise ValueError("delete_scope is first or all, on_corrupt is fail or quarantine")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["basename"], batch["content"]):
                if not content.is_valid:
                    continue
                try:
                    # a file counts as a whole or not at all, so it is read to its end before any row goes out
                    rows = list(changes_in(io.BytesIO(content.as_buffer()), delete_scope, name.as_py()))
                except CORRUPT as e:
                    if on_corrupt == "fail":
                        raise
                    rows = [(name.as_py(), *[None] * 7, f"{type(e).__name__}: {e}")]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return files.select("basename", "content").mapInArrow(run, SCHEMA)


def basename(path: str = "path"):
    return F.element_at(F.split(path, "/"), -1)


def read_changes(spark: SparkSession, paths: list[str], *, delete_scope: str = "first", on_corrupt: str = "fail") -> DataFrame:
    """The changes in the files at these paths or URIs."""
    files = spark.read.format("binaryFile").load(paths).select(basename().alias("basename"), "content")
    return parsed(files, delete_scope=delete_scope, on_corrupt=on_corrupt)
