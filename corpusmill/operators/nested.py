"""Deeply nested citation records into flat, linked tables.

The payload is parsed once into a variant. Nested transform() calls then walk the tree, handing every item the position
of its parent and its own; flatten() joins the arrays of all parents into one array per table, and one inline() per
table emits the rows. Nothing is shuffled and nothing leaves the JVM.

Elements may be missing, null, a plain text or number, an object with its text under "#text", or an array of these.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import strip
from corpusmill.session import checkpointed

#: The item tables; each row has rec_id, parent_no (0: the record), item_no (from 1) and item.
ENTITIES = ("year", "journal", "section", "author", "affiliation", "heading", "qualifier")

_ITEM = "array<struct<entity:string,parent_no:int,item_no:int,item:string>>"


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def _is_object(v: Column) -> Column:
    """Whether a bound variant is an object; the costly cast runs only for what is written like one."""
    return F.coalesce(_get(v, "$", "string").startswith("{") & _get(v, "$", "map<string,variant>").isNotNull(), F.lit(False))


def _plain(v: Column) -> Column:
    """The text of a plain value; null for objects and arrays."""
    return _let(_get(v, "$", "string"), lambda s: F.when(s.startswith("{") & _get(v, "$", "map<string,variant>").isNotNull(), None).when(s.startswith("[") & _get(v, "$", "array<variant>").isNotNull(), None).otherwise(s))


def _text(v: Column) -> Column:
    """The trimmed text of an element, '' if it has none."""
    return _let(v, lambda x: F.coalesce(strip(F.coalesce(_get(x, '$["#text"]', "string"), _plain(x))), F.lit("")))


def _items(v: Column) -> Column:
    """An element that may be repeated, as an array."""
    one = lambda x: F.when(x.isNull() | F.is_variant_null(x), F.array().cast("array<variant>")).otherwise(F.coalesce(_get(x, "$", "array<variant>"), F.array(x)))
    return _let(v, one)


def _first(v: Column) -> Column:
    return F.get(_items(v), 0)


def _digits(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^[0-9]+$", 0), F.lit(""))


def citations(raw: DataFrame, *, rec_id: str = "rec_id", payload: str = "payload") -> DataFrame:
    """The usable records as rec_id, pmid and the variants of the parts: article, mesh, completed.

    A record is usable if its payload is whole JSON that holds, below any of the outer wrappers, a MedlineCitation with a
    PMID of digits only and an Article. Null, empty, cut and foreign payloads give no row.
    """
    parsed = raw.select(F.col(rec_id).alias("rec_id"), F.try_parse_json(F.col(payload)).alias("v"))

    def parts(c: Column) -> Column:
        return F.struct(
            _digits(_text(_first(_get(c, "$.PMID")))).alias("pmid"), _get(c, "$.Article").alias("article"),
            _get(c, "$.MeshHeadingList.MeshHeading").alias("mesh"), _get(c, "$.DateCompleted.Year").alias("completed"),
        )

    inner = lambda v: _first(F.coalesce(_get(v, "$.PubmedArticleSet.PubmedArticle"), _get(v, "$.PubmedArticle")))
    found = _let(F.col("v"), lambda v: _let(F.coalesce(_get(v, "$.MedlineCitation"), _get(inner(v), "$.MedlineCitation")), parts))
    usable = F.filter(F.array(found), lambda p: p["pmid"].isNotNull() & _is_object(p["article"]))
    return _rows(parsed, "rec_id", usable, "article")


def _rows(df: DataFrame, keep: str, items: Column, filled: str) -> DataFrame:
    """inline() of an array that is computed once: for a plain inline the optimiser would add a filter that computes it again."""
    return df.select(keep, F.inline_outer(items)).filter(F.col(filled).isNotNull())


def _row(entity: str, parent: Column, number: Column, item: Column) -> Column:
    return F.struct(F.lit(entity).alias("entity"), parent.cast("int").alias("parent_no"), number.cast("int").alias("item_no"), item.alias("item"))


def _year() -> Column:
    date = _get(F.col("article"), "$.Journal.JournalIssue.PubDate")
    medline = F.nullif(F.regexp_extract(_text(_get(date, "$.MedlineDate")), r"\b(?:19|20)\d{2}\b", 0), F.lit(""))
    return F.coalesce(
        _digits(_text(_get(date, "$.Year"))), medline,
        _digits(_text(_get(_first(_get(F.col("article"), "$.ArticleDate")), "$.Year"))), _digits(_text(F.col("completed"))),
    )


def _sections() -> Column:
    both = F.transform(_items(_get(F.col("article"), "$.Abstract.AbstractText")), lambda s: F.struct(F.coalesce(strip(_get(s, '$["@Label"]', "string")), F.lit("")).alias("label"), _text(s).alias("body")))
    return F.filter(both, lambda s: (s["label"] != "") | (s["body"] != ""))


def _authors() -> Column:
    """Of each author the position, the name and the affiliations with theirs."""
    place = lambda a: F.coalesce(F.nullif(_text(_get(a, "$.Affiliation")), F.lit("")), _text(a))
    name = lambda a: F.coalesce(F.nullif(_text(_get(a, "$.LastName")), F.lit("")), _text(_get(a, "$.CollectiveName")))
    return F.transform(
        _items(_get(F.col("article"), "$.AuthorList.Author")),
        lambda a, i: F.struct(
            _row("author", F.lit(0), i + 1, name(a)).alias("own"),
            F.transform(_items(_get(a, "$.AffiliationInfo")), lambda f, j: _row("affiliation", i + 1, j + 1, place(f))).alias("below"),
        ),
    )


def _headings() -> Column:
    return F.transform(
        _items(F.col("mesh")),
        lambda h, i: F.struct(
            _row("heading", F.lit(0), i + 1, _text(_get(h, "$.DescriptorName"))).alias("own"),
            F.transform(_items(_get(h, "$.QualifierName")), lambda q, j: _row("qualifier", i + 1, j + 1, _text(q))).alias("below"),
        ),
    )


def _arrays(usable: DataFrame) -> DataFrame:
    """One array of rows per table, in columns of the tables' names. Items without text are no rows but keep their position."""
    journal = _text(_get(F.col("article"), "$.Journal.Title"))
    walked = usable.select("rec_id", "pmid", _year().alias("year"), journal.alias("journal"), _sections().alias("sections"), _authors().alias("authors"), _headings().alias("headings"))
    filled = lambda rows: F.filter(rows, lambda r: r["item"].isNotNull() & (r["item"] != ""))
    one = lambda entity, c: filled(F.array(_row(entity, F.lit(0), F.lit(1), c))).cast(_ITEM)
    own = lambda c: filled(F.transform(F.col(c), lambda x: x["own"])).cast(_ITEM)
    below = lambda c: filled(F.flatten(F.transform(F.col(c), lambda x: x["below"]))).cast(_ITEM)
    return walked.select(
        "rec_id", "pmid", one("year", F.col("year")).alias("year"), one("journal", F.col("journal")).alias("journal"),
        F.transform(F.col("sections"), lambda s, i: _row("section", F.lit(0), i + 1, s["label"])).cast(_ITEM).alias("section"),
        F.transform(F.col("sections"), lambda s, i: _row("text", F.lit(0), i + 1, s["body"])).cast(_ITEM).alias("text"),
        own("authors").alias("author"), below("authors").alias("affiliation"), own("headings").alias("heading"), below("headings").alias("qualifier"),
    )


def items(raw: DataFrame, **columns: str) -> DataFrame:
    """All items of all usable records in one table: rec_id, entity, parent_no, item_no, item.

    The position of a section counts sections with a label or a text; other positions count every element. Repeated
    payloads under other ids are records of their own.
    """
    rows = _arrays(citations(raw, **columns)).select("rec_id", F.concat(*ENTITIES).alias("rows"))
    return _rows(rows, "rec_id", F.col("rows"), "entity")


def tables(raw: DataFrame, **columns: str) -> dict[str, DataFrame]:
    """A table per entity (rec_id, parent_no, item_no, item), "text" with the section texts, and "articles".

    The payloads are parsed once: the arrays of all tables are written, and each table is one inline() of its array.
    """
    arrays = checkpointed(_arrays(citations(raw, **columns)))
    out = {e: _rows(arrays, "rec_id", F.col(e), "entity").drop("entity") for e in (*ENTITIES, "text")}
    return out | {"articles": articles(raw, **columns)}


def texts(raw: DataFrame, **columns: str) -> DataFrame:
    """The table of section texts alone."""
    return _rows(_arrays(citations(raw, **columns)), "rec_id", F.col("text"), "entity").drop("entity")


def articles(raw: DataFrame, **columns: str) -> DataFrame:
    """rec_id, pmid, title, abstract, year, journal of the usable records, as the article table has them.

    The abstract is the sections with a blank line between, each as "Label: text"; a section with a label only is "Label:".
    """
    usable = citations(raw, **columns)
    a = usable.select("rec_id", "pmid", _text(_get(F.col("article"), "$.ArticleTitle")).alias("t"), _sections().alias("s"), _year().alias("y"), _text(_get(F.col("article"), "$.Journal.Title")).alias("j"))
    body = F.array_join(F.transform(F.col("s"), lambda s: F.when(s["label"] == "", s["body"]).otherwise(strip(F.concat(s["label"], F.lit(": "), s["body"])))), "\n\n")
    empty = F.lit("")
    return a.select("rec_id", F.col("pmid").cast("bigint").alias("pmid"), F.nullif("t", empty).alias("title"), F.nullif(body, empty).alias("abstract"), F.col("y").try_cast("int").alias("year"), F.nullif("j", empty).alias("journal"))
