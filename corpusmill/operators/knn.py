"""Exact search by inner product, and joining hits to what is known of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are sent to every task at once; more are searched in groups of so many queries and vectors.
QUERY_BLOCK, VECTOR_BLOCK = 20_000, 100_000


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalized(v: Column | str) -> Column:
    """The vector with length one; a zero vector stays as it is. The length is computed once, not for each number."""
    by = lambda n: F.transform(v, lambda x: F.when(n == 0, x.cast("double")).otherwise(x.cast("double") / F.nullif(n, F.lit(0.0))))
    return F.get(F.transform(F.array(norm(v)), by), 0)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and rows of the vectors with dim numbers, none of them null or NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    at = np.flatnonzero(np.asarray(column.is_valid()) & (np.diff(offsets) == dim))
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = flat[offsets[at][:, None] + np.arange(dim)] if len(at) else np.zeros((0, dim))
    good = ~np.isnan(x).any(axis=1)
    return at[good], x[good]


def dimension(vectors: DataFrame, vector: str = "embedding") -> int:
    """The commonest length of the vectors, the smaller of two equally common ones; 0 if there are none."""
    found = vectors.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return found["d"] if found else 0


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "pmid", vector: str = "embedding", query_key: str = "qid", exclude_self: bool = False, dim: int | None = None) -> DataFrame:
    """query_key, key, score, rank of the k largest inner products of every query; equal scores are ordered by key.

    queries has query_key and the vector column. dim is the length of vectors, by default the commonest one among the
    vectors; vectors and queries of another length, or with nulls or NaN, take no part. k is 1 at least; with fewer
    vectors all of them come out. Each task keeps k hits per query over all of its rows before anything is shuffled.

    Up to QUERY_BLOCK queries are sent to the tasks. More of them are cut into blocks, as are the vectors, and each pair
    of blocks is a group of bounded size; then nothing is collected.
    """
    k = max(1, k)
    kinds = dict(queries.dtypes)[query_key], dict(vectors.dtypes)[key]
    hit = f"`{query_key}` {kinds[0]}, `{key}` {kinds[1]}, score double"
    given = vectors.select(key, vector).filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    asked = queries.select(query_key, vector).filter(F.col(vector).isNotNull())
    dim = dimension(vectors, vector) if dim is None else dim
    n = asked.count()
    if n <= QUERY_BLOCK:
        rows = asked.toArrow()
        at, q = _matrix(rows[vector], dim) if rows.num_rows else (np.zeros(0, int), np.zeros((0, dim)))
        ids = rows[query_key].take(pa.array(at)).combine_chunks()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, kind = Best(q, ids, k, exclude_self), None
            for batch in batches:
                kind = batch.schema.field(key).type
                best.see(*_keyed(batch, key, vector, dim))
            yield from best.batches(query_key, key, kind)

        return ranked(given.mapInArrow(run, hit), k, key, query_key)
    asked_blocks, data_blocks = -(-n // QUERY_BLOCK), max(1, -(-given.count() // VECTOR_BLOCK))
    block = lambda c, of: F.pmod(F.xxhash64(c), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    data = given.select("*", block(key, data_blocks).alias("_d"), every(asked_blocks).alias("_q"))
    those = asked.select("*", block(query_key, asked_blocks).alias("_q"), every(data_blocks).alias("_d"))
    return ranked(grouped(data, those, ["_d", "_q"], k, dim, key, vector, query_key, exclude_self), k, key, query_key)


def grouped(data: DataFrame, asked: DataFrame, by: list[str], k: int, dim: int, key: str, vector: str, query_key: str, exclude_self: bool) -> DataFrame:
    """query_key, key, score of the best of each group for the group's queries."""
    kinds = dict(asked.dtypes)[query_key], dict(data.dtypes)[key]

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([(query_key, queries.schema.field(query_key).type), (key, rows.schema.field(key).type), ("score", pa.float64())])
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        at, q = _matrix(queries[vector], dim)
        best = Best(q, queries[query_key].take(pa.array(at)).combine_chunks(), k, exclude_self)
        for batch in rows.select([key, vector]).to_batches(max_chunksize=10_000):
            best.see(*_keyed(batch, key, vector, dim))
        parts = list(best.batches(query_key, key, schema.field(key).type))
        return pa.Table.from_batches(parts).cast(schema) if parts else schema.empty_table()

    return data.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(search, f"`{query_key}` {kinds[0]}, `{key}` {kinds[1]}, score double")


def ranked(hits: DataFrame, k: int, key: str, query_key: str) -> DataFrame:
    """The k best of the lists of each query, which are as many as tasks or groups saw it."""
    rank = hits.withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key)))
    return rank.filter(F.col("rank") <= k).select(query_key, key, F.round("score", 6).alias("score"), "rank")


def _keyed(batch: pa.RecordBatch, key: str, vector: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    at, x = _matrix(batch[vector], dim)
    return batch[key].take(pa.array(at)).to_numpy(zero_copy_only=False), x


class Best:
    """The k best keys of each query over all rows seen so far; equal scores are ordered by key."""

    def __init__(self, q: np.ndarray, ids: pa.Array, k: int, exclude_self: bool):
        self.q, self.ids, self.k, self.exclude = q, ids, k, exclude_self
        self.own = ids.to_numpy(zero_copy_only=False)
        self.score = np.full((len(q), k), -np.inf)
        self.keys: np.ndarray | None = None

    def see(self, keys: np.ndarray, x: np.ndarray) -> None:
        if not len(keys) or not len(self.q):
            return
        if self.keys is None:
            self.keys = np.full(self.score.shape, keys[0], keys.dtype)
        for a in range(0, len(self.q), 512):
            b = min(a + 512, len(self.q))
            # rounded, so that the order doesn't hang on the order of additions
            s = np.round(self.q[a:b] @ x.T, 9)
            if self.exclude:
                s[self.own[a:b, None] == keys] = -np.inf
            # what may be among the best: no worse than the k-th of these rows and the k-th so far
            least = self.score[a:b, -1]
            if len(keys) > self.k:
                least = np.maximum(least, np.partition(s, len(keys) - self.k, axis=1)[:, len(keys) - self.k])
            row, col = np.nonzero((s >= least[:, None]) & np.isfinite(s))
            kept = np.isfinite(self.score[a:b])
            r = np.concatenate([np.nonzero(kept)[0], row])
            v = np.concatenate([self.score[a:b][kept], s[row, col]])
            c = np.concatenate([self.keys[a:b][kept], keys[col]])
            order = np.lexsort((c if c.dtype != object else np.unique(c, return_inverse=True)[1], -v, r))
            r, v, c = r[order], v[order], c[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            good = place < self.k
            self.score[a:b] = -np.inf
            self.score[a + r[good], place[good]], self.keys[a + r[good], place[good]] = v[good], c[good]

    def batches(self, query_key: str, key: str, kind: pa.DataType | None) -> Iterator[pa.RecordBatch]:
        """query_key, key, score of all that is held."""
        if self.keys is None:
            return
        for a in range(0, len(self.q), 10_000):
            row, col = np.nonzero(np.isfinite(self.score[a : a + 10_000]))
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(row + a)), pa.array(self.keys[row + a, col], kind), pa.array(self.score[row + a, col])], [query_key, key, "score"])


def hydrated(hits: DataFrame, articles: DataFrame, key: str = "pmid") -> DataFrame:
    """All hits with title, abstract, year and journal, null where the article is unknown. Hits come first: they are few."""
    known = articles.select(key, "title", "abstract", "year", "journal")
    return hits.join(known, key, "left")
