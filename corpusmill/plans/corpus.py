"""Queries of the corpus pipeline's own operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import search
from corpusmill.embedding import HashingEmbedder, embed
from corpusmill.functions import text
from corpusmill.operators import changes, ivf, knn, pending, stats
from corpusmill.plans.tables import table
from corpusmill.session import checkpointed
from corpusmill.sources import listing

#: Every row whose id is divisible by this is a query of the search queries.
EVERY = 20
K = 10
SHARDS = 3
#: Length of the given vectors.
DIM = 64


def _articles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles")


def _done(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embedded_pmids").select("pmid").distinct()


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("pmid"), "embedding")


def _queries(vectors: DataFrame) -> DataFrame:
    return vectors.filter(F.col("pmid") % EVERY == 0).select(F.col("pmid").alias("qid"), "embedding")


def eligible(spark: SparkSession, d: str) -> DataFrame:
    return pending.eligible(_articles(spark, d)).select("pmid")


def pending_rows(spark: SparkSession, d: str) -> DataFrame:
    return pending.pending(_articles(spark, d), _done(spark, d)).select("pmid")


def pending_two_states(spark: SparkSession, d: str) -> DataFrame:
    return pending.pending(_articles(spark, d), _done(spark, d), table(spark, d, "article_vectors").select("pmid")).select("pmid")


def pending_by_shard(spark: SparkSession, d: str) -> DataFrame:
    rows = pending.pending(_articles(spark, d), _done(spark, d)).select("pmid")
    return rows.groupBy((F.col("pmid") % SHARDS).alias("shard")).agg(F.count("*").alias("rows"), F.min("pmid").alias("first"), F.max("pmid").alias("last"))


def pending_limit_then_shard(spark: SparkSession, d: str) -> DataFrame:
    """The limit is the feature: it is applied to eligible rows before the shard and the state."""
    return pending.pending(_articles(spark, d), _done(spark, d), limit=2_000, shard=(1, SHARDS)).select("pmid")


def pending_count(spark: SparkSession, d: str) -> DataFrame:
    return pending.pending(_articles(spark, d), _done(spark, d)).agg(F.count("*").alias("pending"))


def keyset_batch(spark: SparkSession, d: str) -> DataFrame:
    """A page of rows after a key; its size is the feature."""
    return pending.batch(_articles(spark, d), _done(spark, d), size=32, after=10_100_000).select("pmid")


def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    return pending.insert_if_absent(_done(spark, d), table(spark, d, "article_vectors").select("pmid"))


def shard_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return pending.duplicated(table(spark, d, "embedded_pmids"))


def new_files(spark: SparkSession, d: str) -> DataFrame:
    """Of all loads seen in the tables, with the latest size and time the ledger has, those not in the ledger under its first entry."""
    ledger = table(spark, d, "ingested_files")
    latest = ledger.groupBy("basename").agg(F.max(F.struct("mtime_ns", "size_bytes")).alias("m"))
    earliest = ledger.groupBy("basename").agg(F.min(F.struct("mtime_ns", "size_bytes")).alias("m"))
    seen = _articles(spark, d).select("basename").union(table(spark, d, "article_changes").select("basename")).distinct()
    flat = lambda df: df.select("basename", F.col("m.size_bytes").alias("size_bytes"), F.col("m.mtime_ns").alias("mtime_ns"))
    return pending.new_files(seen.join(flat(latest), "basename"), flat(earliest)).select("basename", "size_bytes", "mtime_ns")


def profile_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.counts(_articles(spark, d))


def articles_per_year(spark: SparkSession, d: str) -> DataFrame:
    return stats.per_year(_articles(spark, d))


def word_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.word_stats(_articles(spark, d))


def word_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.word_histogram(_articles(spark, d), bins=30).select("bin", "articles")


def prompts(spark: SparkSession, d: str) -> DataFrame:
    """The texts to embed, cut at the length that a model takes: the limit is the feature."""
    return pending.eligible(_articles(spark, d)).select("pmid", text.prompt("title", "abstract", 512).alias("prompt"))


def previews(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).select("pmid", *[text.preview("abstract", n).alias(f"preview_{n}") for n in (3, 35, 280)])


def journal_slugs(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).filter(F.col("journal").isNotNull()).groupBy(text.slug("journal").alias("slug")).agg(F.count("*").alias("articles"))


def years_in_text(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).groupBy(text.year_in("title").alias("year")).agg(F.count("*").alias("articles"))


def listed_links(spark: SparkSession, d: str) -> DataFrame:
    """A directory page per kind of load is made of the ledger, then read for links."""
    kind = F.regexp_extract("basename", "^([a-z]+)", 1)
    entry = F.concat(F.lit('<a href="../">up</a><a class="f" href="'), F.col("basename"), F.lit('">'), F.col("basename"), F.lit("</a><a href='notes.txt'>n</a>"))
    pages = table(spark, d, "ingested_files").select(F.concat(F.lit("https://files.invalid/"), kind, F.lit("/")).alias("url"), entry.alias("html"))
    return listing.listed_files(pages)


def user_state(spark: SparkSession, d: str) -> DataFrame:
    """The event stream as changes of users: an error deletes, a purchase replaces, others update."""
    e = table(spark, d, "events")
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "purchase", "insert").otherwise("update")
    feed = e.select(F.concat(F.lit("0n"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string")).alias("basename"), F.col("event_id").alias("ordinal"), op.alias("op"), "user_id", "event_type", F.col("value").alias("value"), F.col("ts").alias("arrived_at"))
    return changes.apply_changes(feed, "user_id", ["event_type", "value"], trace=False).select("user_id", "event_type", F.round("value", 6).alias("value"))


def l2_norms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(knn.norm("embedding"), 6).alias("norm"))


def normalized(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", knn.normalized("embedding").alias("v"))
    return v.select("vec_id", F.posexplode("v").alias("at", "x")).select("vec_id", "at", F.round("x", 6).alias("x"))


def knn_exact(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return knn.top_k(v, _queries(v), K)


def knn_without_self(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return knn.top_k(v, _queries(v), K, exclude_self=True)


def knn_hydrated(spark: SparkSession, d: str) -> DataFrame:
    """Hits with what documents say of them; the first line is the title."""
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("pmid"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), F.lit(None).cast("int").alias("year"), F.col("source").alias("journal"),
    )
    return knn.hydrated(knn_exact(spark, d), docs).select("qid", "pmid", "rank", "score", "title", "journal")


def ivf_all_cells(spark: SparkSession, d: str) -> DataFrame:
    """Probing every cell must give what exact search gives."""
    v = _vectors(spark, d)
    c = ivf.fit(v, ivf.Params(cells=16))
    return ivf.search(ivf.assign(v, c), c, _queries(v), K, len(c))


def _unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "article_vectors").filter(F.col("pmid").isNotNull() & (F.size("embedding") == DIM)).distinct()
    n = knn.norm("embedding")
    return v.filter((n > 0) & ~F.isnan(n)).select("pmid", knn.normalized("embedding").alias("embedding"))


def ivf_article_search(spark: SparkSession, d: str) -> DataFrame:
    """Approximate search over the directions of the article vectors, with cells and probes that follow the data."""
    v = checkpointed(_unit_vectors(spark, d))
    c, probes = ivf.build(v)
    return ivf.search(checkpointed(ivf.assign(v, c)), c, _queries(v), K, probes)


def ivf_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether the approximate search finds at least 0.95 of what the exact one finds."""
    v = checkpointed(_unit_vectors(spark, d))
    c, probes = ivf.build(v)
    found = ivf.search(checkpointed(ivf.assign(v, c)), c, _queries(v), K, probes).select("qid", "pmid", F.lit(1).alias("found"))
    exact = knn.top_k(v, _queries(v), K)
    both = exact.join(found, ["qid", "pmid"], "left")
    return both.agg(F.count_distinct("qid").alias("queries"), F.count("*").alias("wanted"), (F.count("found") >= 0.95 * F.count("*")).alias("reached"))


def shard_union(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    parts = [v.filter(F.col("pmid") % SHARDS == k) for k in range(SHARDS)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.select("pmid", F.size("embedding").alias("dim"))


def embedded_articles(spark: SparkSession, d: str) -> DataFrame:
    """All pending articles through the deterministic embedder."""
    rows = pending.pending(_articles(spark, d), _done(spark, d)).select("pmid", text.prompt("title", "abstract").alias("prompt"))
    return embed(rows, lambda _: HashingEmbedder(), on_empty="skip")


def embedded_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Which articles get a vector, and of what length."""
    return embedded_articles(spark, d).select("pmid", F.size("embedding").alias("dim"))


def search_hits(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the usual search end to end, a text against all articles, embedded on the way."""
    articles = _articles(spark, d)
    rows = pending.eligible(articles).select("pmid", text.prompt("title", "abstract").alias("prompt"))
    vectors = embed(rows, lambda _: HashingEmbedder(), on_empty="skip")
    query = HashingEmbedder()(["viral load in dialysis patients after transplantation"])[0]
    return search.hits(spark, vectors, articles, query, k=K)


QUERIES = {
    "eligible": eligible,
    "pending": pending_rows,
    "pending_two_states": pending_two_states,
    "pending_by_shard": pending_by_shard,
    "pending_limit_then_shard": pending_limit_then_shard,
    "pending_count": pending_count,
    "keyset_batch": keyset_batch,
    "insert_if_absent": insert_if_absent,
    "shard_duplicates": shard_duplicates,
    "new_files": new_files,
    "profile_counts": profile_counts,
    "articles_per_year": articles_per_year,
    "word_stats": word_stats,
    "word_histogram": word_histogram,
    "prompts": prompts,
    "previews": previews,
    "journal_slugs": journal_slugs,
    "years_in_text": years_in_text,
    "listed_links": listed_links,
    "user_state": user_state,
    "l2_norms": l2_norms,
    "normalized": normalized,
    "knn_exact": knn_exact,
    "knn_without_self": knn_without_self,
    "knn_hydrated": knn_hydrated,
    "ivf_all_cells": ivf_all_cells,
    "ivf_article_search": ivf_article_search,
    "ivf_recall": ivf_recall,
    "shard_union": shard_union,
    "embedded_articles": embedded_articles,
    "embedded_sizes": embedded_sizes,
    "search_hits": search_hits,
}

_ELIGIBLE = "title is not null and abstract is not null and trim(title, ' ') <> '' and trim(abstract, ' ') <> ''"
_OPEN = f"{_ELIGIBLE} and not exists (select 1 from embedded_pmids e where e.pmid = a.pmid)"
# White space as strip() knows it.
_WS = r"[\t-\r\x1c-\x20\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(sql: str) -> str:
    return f"regexp_replace({sql}, '^{_WS}+|{_WS}+$', '', 'g')"


_T, _A = _strip("title"), _strip("abstract")
_WORDS = f"""w as (select case when p = '' then 0 else len(regexp_split_to_array(p, '{_WS}+')) end w
  from (select concat_ws(' ', nullif({_T}, ''), nullif({_A}, '')) p from articles))"""
_KNN = """select qid, pmid, score, rank from (
  select q.vec_id qid, e.vec_id pmid, round(list_inner_product(q.embedding::double[], e.embedding::double[]), 6) score,
    row_number() over (partition by q.vec_id order by round(list_inner_product(q.embedding::double[], e.embedding::double[]), 9) desc, e.vec_id) rank
  from embeddings q, embeddings e where q.vec_id % 20 = 0 {}) where rank <= 10"""

# The words of an abstract with single blanks, and the preview of n characters made of them.
_FLAT = f"array_to_string(list_filter(regexp_split_to_array(abstract, '{_WS}+'), lambda x: x <> ''), ' ')"


def _preview(n: int) -> str:
    head = f"rtrim(substr(flat, 1, {n - 3}), ' ')"
    tail = f"split_part({head}, ' ', -1)"
    before = f"substr({head}, 1, greatest(0, length({head}) - length({tail}) - 1))"
    cut = f"case when contains({head}, ' ') and {before} <> '' and length({tail}) < {max(8, n // 4)} then {before} else {head} end"
    return f"case when length(flat) <= {n} then flat else {cut} || '...' end preview_{n}"


ORACLES = {
    "previews": f"select pmid, substr(flat, 1, 3) preview_3, {_preview(35)}, {_preview(280)} from (select pmid, {_FLAT} flat from articles)",
    "eligible": f"select pmid from articles where {_ELIGIBLE}",
    "pending": f"select pmid from articles a where {_OPEN}",
    "pending_two_states": f"select pmid from articles a where {_OPEN} and pmid not in (select pmid from article_vectors where pmid is not null)",
    "pending_by_shard": f'select pmid % 3 shard, count(*) "rows", min(pmid) "first", max(pmid) "last" from articles a where {_OPEN} group by 1',
    "pending_limit_then_shard": f"with a as (select * from articles where {_ELIGIBLE} order by pmid limit 2000) select pmid from a where pmid % 3 = 1 and not exists (select 1 from embedded_pmids e where e.pmid = a.pmid)",
    "pending_count": f"select count(*) pending from articles a where {_OPEN}",
    "keyset_batch": f"select pmid from articles a where {_OPEN} and pmid > 10100000 order by pmid limit 32",
    "insert_if_absent": "select pmid from embedded_pmids union select pmid from article_vectors where pmid is not null",
    "shard_duplicates": "select pmid, count(*) n, count(distinct shard) parts from embedded_pmids group by pmid having count(*) > 1",
    "new_files": """with seen as (select basename from articles union select basename from article_changes),
      m as (select basename, max((mtime_ns, size_bytes)) hi, min((mtime_ns, size_bytes)) lo from ingested_files group by 1)
      select basename, hi[2] size_bytes, hi[1] mtime_ns from m join seen using (basename) where hi <> lo""",
    "profile_counts": f"""select count(*) total, count(*) filter (where t) title_missing, count(*) filter (where b) abstract_missing,
      count(*) filter (where t and b) both_missing, count(*) filter (where not t and not b) both_present
      from (select coalesce({_T}, '') = '' t, coalesce({_A}, '') = '' b from articles)""",
    "articles_per_year": """select coalesce("year"::varchar, 'unknown') "year", count(*) articles from articles group by 1""",
    "word_stats": f"with {_WORDS} select coalesce(min(w), 0) words_min, coalesce(max(w), 0) words_max, round(coalesce(avg(w), 0), 6) words_mean, round(coalesce(quantile_cont(w, 0.995), 0), 6) words_p995 from w",
    "word_histogram": f"""with {_WORDS},
      c as (select greatest(500, ceil(quantile_cont(w, 0.995) / 50) * 50)::double cap, least(30, greatest(5, count(*)))::int nb from w),
      b as (select least(w, cap) v, cap, nb, cap / nb step, least(floor(least(w, cap) * nb / cap), nb - 1) b0 from w, c),
      l as (select *, case when v < b0 * step then b0 - 1 else b0 end b1 from b),
      f as (select case when v >= (case when b1 + 1 = nb then cap else (b1 + 1) * step end) and b1 <> nb - 1 then b1 + 1 else b1 end bin from l)
      select r.range::int bin, count(f.bin) articles from range((select nb from c)) r left join f on f.bin = r.range group by 1""",
    "embedded_sizes": f"""select pmid, 64::int dim from articles a where {_OPEN} and {_strip(f"replace(concat_ws(' ', {_T}, {_A}), chr(0), '')")} <> ''""",
    "prompts": f"select pmid, substr({_strip(f"replace(concat_ws(' ', {_T}, {_A}), chr(0), '')")}, 1, 512) prompt from articles where {_ELIGIBLE}",
    "journal_slugs": """select coalesce(nullif(lower(trim(regexp_replace(journal, '[^a-zA-Z0-9._-]+', '-', 'g'), '-')), ''), 'model') slug, count(*) articles
      from articles where journal is not null group by 1""",
    "years_in_text": r"""select try_cast(nullif(regexp_extract(title, '\b(?:19|20)\d{2}\b'), '') as integer) "year", count(*) articles from articles group by 1""",
    "listed_links": """select distinct basename "name", 'https://files.invalid/' || regexp_extract(basename, '^([a-z]+)', 1) || '/' || basename url
      from ingested_files where basename like '_%.xml.gz'""",
    "user_state": """with e as (select *, row_number() over (partition by user_id order by epoch_us(ts) // 1000000, event_type = 'error', event_id) n from events),
      l as (select user_id, max_by(event_type, n) event_type, max_by("value", n) "value" from (select *, row_number() over (partition by user_id order by n desc) r from e) where r = 1 group by 1)
      select user_id, event_type, round("value", 6) "value" from l where event_type <> 'error'""",
    "l2_norms": "select vec_id, round(sqrt(list_inner_product(embedding::double[], embedding::double[])), 6) norm from embeddings",
    "normalized": """select vec_id, unnest(range(len(embedding)))::int "at", round(unnest(embedding::double[]) / sqrt(list_inner_product(embedding::double[], embedding::double[])), 6) x from embeddings""",
    "knn_exact": _KNN.format(""),
    "knn_without_self": _KNN.format("and q.vec_id <> e.vec_id"),
    "knn_hydrated": f"""select k.qid, k.pmid, k.rank, k.score, split_part(d.text, chr(10), 1) title, d.source journal from ({_KNN.format("")}) k left join documents d on d.doc_id = k.pmid""",
    "ivf_all_cells": _KNN.format(""),
    "ivf_recall": """with v as (select distinct pmid, embedding from article_vectors where pmid is not null and len(embedding) = 64
        and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x))) and list_inner_product(embedding::double[], embedding::double[]) > 0),
      q as (select pmid, count(*) c from v where pmid % 20 = 0 group by 1)
      select count(*) queries, coalesce(sum(least(10, (select count(*) from v))), 0)::bigint wanted, true reached from q""",
    "shard_union": "select vec_id pmid, len(embedding)::int dim from embeddings",
}
