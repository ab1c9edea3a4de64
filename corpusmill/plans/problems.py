"""Queries of the general data-preparation problems (p1, p2, p4) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import changes, nested, quality
from corpusmill.plans.tables import table
from corpusmill.session import checkpointed

FIELDS = ("title", "abstract", "year", "journal")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    # rec_id is unique, so entity and positions make every row distinct: nothing has to be shuffled
    return nested.items(table(spark, d, "raw_citations"))


def p1_articles(spark: SparkSession, d: str) -> DataFrame:
    return nested.articles(table(spark, d, "raw_citations"))


def p1_texts(spark: SparkSession, d: str) -> DataFrame:
    return nested.texts(table(spark, d, "raw_citations"))


def p1_qualifiers(spark: SparkSession, d: str) -> DataFrame:
    """One of the tables that are made together, with the headings that its rows belong to."""
    t = nested.tables(table(spark, d, "raw_citations"))
    heading = t["heading"].select("rec_id", F.col("item_no").alias("parent_no"), F.col("item").alias("heading"))
    return t["qualifier"].join(heading, ["rec_id", "parent_no"], "left").select("rec_id", "parent_no", "item_no", "item", "heading")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return changes.apply_changes(table(spark, d, "article_changes"), "pmid", ())


def p2_state(spark: SparkSession, d: str) -> DataFrame:
    return changes.apply_changes(table(spark, d, "article_changes"), "pmid", FIELDS)


def p2_patched(spark: SparkSession, d: str) -> DataFrame:
    return changes.apply_changes(table(spark, d, "article_changes"), "pmid", FIELDS, update="patch", trace=False)


#: Fixed values of the problem: the years that an article can have.
YEARS = (1800, 2027)


#: Text columns, and whether markup is a violation there.
TEXTS = {"title": True, "abstract": False}


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The articles, the violations among their texts, and the profile of every load and field."""
    articles = table(spark, d, "articles")
    values = quality.measured(articles, TEXTS, load="basename", key="pmid")
    suspects, others = quality.judged(values)
    counts = quality.value_counts(values, suspects, others).unionByName(quality.number_counts(articles, "year", *YEARS, load="basename"))
    return articles, quality.violations(suspects), quality.load_profile(checkpointed(counts))


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    """The measures of every load and field, long."""
    return _judged(spark, d)[2]


def p4_years(spark: SparkSession, d: str) -> DataFrame:
    """The profile of the years alone."""
    profile = quality.load_profile(checkpointed(quality.number_counts(table(spark, d, "articles"), "year", *YEARS, load="basename")))
    return profile.select("load", "rows", "n", "different", *[F.round(m, 6).alias(m) for m in ("null_rate", "distinct_share", "repeats", "top_share", "center", "divergence")])


def p4_departures(spark: SparkSession, d: str) -> DataFrame:
    """Which loads depart from the others, in which measure, with the usual value beside it."""
    return _departures(_judged(spark, d)[2])


def _departures(profile: DataFrame) -> DataFrame:
    x = quality.Limits()
    floors = {"null_rate": x.rate, "repeats": x.distinct, "top_share": x.distinct, "divergence": x.divergence}
    # years are few, so the share of different ones only tells how large a load is
    text = {"center": x.length, "distinct_share": x.distinct}
    return quality.departures(profile, floors, x, own={f: text for f in TEXTS} | {"year": {"center": x.position}})


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    articles, values, profile = _judged(spark, d)
    values = values.unionByName(quality.range_violations(articles, "year", *YEARS, key="pmid", load="basename"))
    loads = _departures(profile).select("field", "load", F.lit(0).cast("bigint").alias("key"))
    return values.unionByName(loads).select("field", F.col("load").alias("basename"), F.col("key").alias("pmid")).distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_articles": p1_articles,
    "p1_texts": p1_texts,
    "p1_qualifiers": p1_qualifiers,
    "p2_found": p2_found,
    "p2_state": p2_state,
    "p2_patched": p2_patched,
    "p4_found": p4_found,
    "p4_profile": p4_profile,
    "p4_departures": p4_departures,
    "p4_years": p4_years,
}

#: The changes in their order, by key, as seq.
CHANGES_SQL = r"""
with rows as (
  select *, lower(substr(ltrim(op, ' ' || chr(9) || chr(10)), 1, 1)) kind,
    coalesce(try_cast(regexp_extract(basename, '(\d+)n(\d+)', 1) as bigint), -1) major,
    coalesce(try_cast(regexp_extract(basename, '(\d+)n(\d+)', 2) as bigint), -1) minor
  from article_changes where pmid is not null),
one as (
  select * from rows where kind in ('i', 'u', 'd')
  qualify row_number() over (partition by basename, ordinal order by arrived_at desc nulls last, kind desc, pmid desc) = 1),
seq as (
  select *, row_number() over (partition by pmid order by major, minor, (kind = 'd')::int, ordinal) n from one)
"""

# The SQL for problem 1, put together from the same few readings of an element.
_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160) || chr(8194) || chr(8195) || chr(8201) || chr(12288)"


def _sql_text(x: str) -> str:
    inner = f"""case when json_type({x}->'$."#text"') in ('OBJECT', 'ARRAY') then null else {x}->>'$."#text"' end"""
    return f"trim(coalesce(case json_type({x}) when 'OBJECT' then {inner} when 'ARRAY' then null else {x}->>'$' end, ''), {_BLANKS})"


def _sql_items(x: str) -> str:
    return f"(case when {x} is null or json_type({x}) = 'NULL' then []::json[] when json_type({x}) = 'ARRAY' then cast({x} as json[]) else [{x}] end)"


def _sql_each(x: str) -> str:
    return f"unnest({_sql_items(x)}) x, unnest(range(1, len({_sql_items(x)}) + 1))::int n"


def _sql_digits(x: str) -> str:
    return f"nullif(regexp_extract({_sql_text(x)}, '^[0-9]+$'), '')"


_CITATIONS = rf"""
with r as (select rec_id, try_cast(payload as json) j from raw_citations where json_valid(payload)),
w as (select rec_id, j, {_sql_items("coalesce(j->'$.PubmedArticleSet.PubmedArticle', j->'$.PubmedArticle')")}[1] a from r where json_type(j) = 'OBJECT'),
c as (select rec_id, coalesce(j->'$.MedlineCitation', a->'$.MedlineCitation') c from w),
u as (select rec_id, c->'$.Article' a, c->'$.MeshHeadingList.MeshHeading' m, c->'$.DateCompleted.Year' d, c->'$.PMID' p from c),
ok as (select *, a->'$.Journal.JournalIssue.PubDate' pd from u where json_type(a) = 'OBJECT' and {_sql_digits("p")} is not null),
y as (select rec_id, coalesce({_sql_digits("(pd->'$.Year')")}, nullif(regexp_extract({_sql_text("(pd->'$.MedlineDate')")}, '\b(?:19|20)\d{{2}}\b'), ''),
  {_sql_digits(f"({_sql_items("(a->'$.ArticleDate')")}[1]->'$.Year')")}, {_sql_digits("d")}) item from ok),
s0 as (select rec_id, {_sql_each("(a->'$.Abstract.AbstractText')")} from ok),
s1 as (select rec_id, n, trim(coalesce(case when json_type(x) = 'OBJECT' then x->>'$."@Label"' end, ''), {_BLANKS}) label, {_sql_text("x")} body from s0),
s as (select rec_id, row_number() over (partition by rec_id order by n)::int n, label, body from s1 where label <> '' or body <> ''),
au as (select rec_id, {_sql_each("(a->'$.AuthorList.Author')")} from ok),
af as (select rec_id, n pn, {_sql_each("(x->'$.AffiliationInfo')")} from au),
h as (select rec_id, {_sql_each("m")} from ok),
q as (select rec_id, n pn, {_sql_each("(x->'$.QualifierName')")} from h)
"""

ORACLES = {
    "p1_found": _CITATIONS + f"""
select rec_id, entity, parent_no, item_no, item from (
  select rec_id, 'year' entity, 0 parent_no, 1 item_no, item from y
  union all select rec_id, 'journal', 0, 1, {_sql_text("(a->'$.Journal.Title')")} from ok
  union all select rec_id, 'author', 0, n, coalesce(nullif({_sql_text("(x->'$.LastName')")}, ''), {_sql_text("(x->'$.CollectiveName')")}) from au
  union all select rec_id, 'affiliation', pn, n, coalesce(nullif({_sql_text("(x->'$.Affiliation')")}, ''), {_sql_text("x")}) from af
  union all select rec_id, 'heading', 0, n, {_sql_text("(x->'$.DescriptorName')")} from h
  union all select rec_id, 'qualifier', pn, n, {_sql_text("x")} from q) where item <> ''
union all select rec_id, 'section', 0, n, label from s
""",
    "p1_qualifiers": _CITATIONS + f"""
select q.rec_id, pn parent_no, q.n item_no, {_sql_text("q.x")} item, nullif({_sql_text("(h.x->'$.DescriptorName')")}, '') heading
from q join h on h.rec_id = q.rec_id and h.n = q.pn where {_sql_text("q.x")} <> ''
""",
    "p1_texts": _CITATIONS + "select rec_id, 0 parent_no, n item_no, body item from s",
    "p1_articles": _CITATIONS + f"""
select ok.rec_id, cast({_sql_digits("p")} as bigint) pmid, nullif({_sql_text("(a->'$.ArticleTitle')")}, '') title, t.abstract, try_cast(y.item as int) "year",
  nullif({_sql_text("(a->'$.Journal.Title')")}, '') journal
from ok join y using (rec_id) left join (
  select rec_id, string_agg(case when label = '' then body else trim(label || ': ' || body, {_BLANKS}) end, chr(10) || chr(10) order by n) abstract from s group by 1) t using (rec_id)
""",
    "p2_found": CHANGES_SQL + """
select pmid, basename, ordinal from seq qualify row_number() over (partition by pmid order by n desc) = 1 and kind <> 'd'
""",
    "p2_state": CHANGES_SQL + """
select pmid, title, abstract, "year", journal, basename, ordinal from seq
qualify row_number() over (partition by pmid order by n desc) = 1 and kind <> 'd'
""",
    "p4_years": """
with v as (select basename, case when "year" between 1800 and 2027 then "year" end y, "year" is null missing from articles),
e as (select basename, y, count(*) c from v where y is not null group by all),
f as (select basename, y // 10 form, sum(c) m from e group by all),
w as (select form, sum(m) / sum(sum(m)) over () q from f group by form),
l as (select basename, count(*) r, count(y) n, count(*) filter (where missing) nulls from v group by 1),
s as (select basename, count(*) different, sum(c * (c - 1)) same, max(c) most, sum(c * y) total from e group by 1),
d as (select basename, sum(case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end + q * log2(q / ((p + q) / 2))) / 2 + (1 - sum(q)) / 2 divergence
  from (select f.basename, f.m / l.n p, w.q from f join w using (form) join l using (basename)) group by 1)
select basename "load", r "rows", n, coalesce(different, 0) "different", round(nulls / r, 6) null_rate, round(different / n, 6) distinct_share,
  case when n > 1 then round(same / (n * (n - 1)), 6) end repeats, round(most / n, 6) top_share, round(total / n, 6) center, round(divergence, 6) divergence
from l left join s using (basename) left join d using (basename)
""",
    "p2_patched": CHANGES_SQL + """,
reset as (select *, coalesce(max(case when kind <> 'u' then n end) over (partition by pmid), 0) r, arg_max(kind, n) over (partition by pmid) last_kind from seq)
select pmid,
  arg_max(title, n) filter (where kind <> 'd' and n >= r and (kind = 'i' or title is not null)) title,
  arg_max(abstract, n) filter (where kind <> 'd' and n >= r and (kind = 'i' or abstract is not null)) abstract,
  arg_max("year", n) filter (where kind <> 'd' and n >= r and (kind = 'i' or "year" is not null)) "year",
  arg_max(journal, n) filter (where kind <> 'd' and n >= r and (kind = 'i' or journal is not null)) journal
from reset where last_kind <> 'd' group by pmid
""",
}
