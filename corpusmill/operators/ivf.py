"""Approximate search over vectors partitioned by their nearest centroid.

The centroids are fitted on a bounded sample; every vector is assigned to a cell and written under it. A query reads the
cells of its nearest centroids only (a partition filter on the scan) and ranks them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import knn


@dataclass(frozen=True)
class Params:
    """cells: number of partitions, by default one per rows vectors as far as the sample can tell so many apart.

    probes: cells that a query reads, by default as many as reach the recall on the sample. sample: vectors that the
    centroids are fitted on. block: vectors of one cell that are searched at once by a set of queries.
    """

    cells: int | None = None
    probes: int | None = None
    recall: float = 0.97
    rows: int = 500
    block: int = 50_000
    sample: int = 20_000
    rounds: int = 10
    seed: int = 42

    def __post_init__(self):
        if min(x for x in (self.cells, self.probes, self.sample, self.rows, self.block) if x is not None) < 1 or not 0 < self.recall <= 1:
            raise ValueError("cells, probes, sample, rows and block are 1 at least, recall is above 0 and 1 at most")


#: Sampled vectors that a centroid needs at least, and sampled queries that the probes are measured with.
_PER_CELL, _TRIED = 32, 500


def _sample(vectors: DataFrame, params: Params, vector: str) -> tuple[int, np.ndarray]:
    """The number of vectors and the directions of a sample of about the given size, taken from all partitions alike."""
    n = vectors.count()
    rows = vectors.select(vector).sample(min(1.0, params.sample / max(1, n)), params.seed).toArrow()
    lengths = pd.Series([len(v) for v in rows[vector].to_pylist() if v is not None]).mode()
    if not len(lengths):
        return n, np.zeros((0, 0))
    _, x = knn._matrix(rows[vector], int(lengths[0]))
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return n, x[size[:, 0] > 0] / size[size[:, 0] > 0]


def _centroids(n: int, x: np.ndarray, params: Params) -> np.ndarray:
    rng = np.random.default_rng(params.seed)
    cells = params.cells or max(1, min(n // params.rows, len(x) // _PER_CELL))
    if not len(x):
        return x
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(params.rounds):
        cell = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, cell, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(length > 0, sums / np.maximum(length, 1e-12), c)
    return c


def fit(vectors: DataFrame, params: Params = Params(), *, vector: str = "embedding") -> np.ndarray:
    """Centroids (cells x dim) of spherical k-means on a bounded sample."""
    return _centroids(*_sample(vectors, params, vector), params)


def build(vectors: DataFrame, params: Params = Params(), *, k: int = 10, vector: str = "embedding") -> tuple[np.ndarray, int]:
    """Centroids and the number of cells to probe.

    The probes are the fewest that find the given share of the k nearest of sampled queries within the sample, whose
    neighbours are farther away than those in all vectors and so lie in more cells.
    """
    n, x = _sample(vectors, params, vector)
    c = _centroids(n, x, params)
    if params.probes or not len(c):
        return c, min(params.probes or 1, max(1, len(c)))
    q = x[:_TRIED]
    s = q @ x.T
    s[np.arange(len(q)), np.arange(len(q))] = -np.inf
    near = np.argsort(-s, axis=1)[:, : min(k, len(x) - 1)]
    place = np.argsort(np.argsort(-(q @ c.T), axis=1), axis=1)  # of every cell in the order of each query
    at = np.take_along_axis(place, (x @ c.T).argmax(1)[near], axis=1)
    return c, 1 + int(np.quantile(at, params.recall, method="higher")) if at.size else 1


def assign(vectors: DataFrame, centroids: np.ndarray, *, key: str = "pmid", vector: str = "embedding") -> DataFrame:
    """key, vector, cell of the vectors of the centroids' length; others and nulls are left out."""
    kind = dict(vectors.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = knn._matrix(batch[vector], centroids.shape[1])
            rows = pa.array(at)
            cell = (x @ centroids.T).argmax(1) if len(at) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch[key].take(rows), batch[vector].take(rows), pa.array(cell, pa.int32())], [key, vector, "cell"])

    return vectors.select(key, vector).filter(F.col(vector).isNotNull()).mapInArrow(run, f"`{key}` {kind}, `{vector}` {dict(vectors.dtypes)[vector]}, cell int")


def probed(query: np.ndarray, centroids: np.ndarray, probes: int) -> list[int]:
    return [int(i) for i in np.argsort(-(centroids @ query), kind="stable")[: max(1, probes)]]


def search(
    indexed: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int, probes: int, *, key: str = "pmid", vector: str = "embedding", query_key: str = "qid",
    exclude_self: bool = False, block: int = Params.block,
) -> DataFrame:
    """As knn.top_k, over the cells of each query's nearest centroids.

    One query filters the partitions of the scan. A set of queries is spread over its cells, of which those with more
    than block vectors are cut into blocks; each block is one group, and the lists of a query's blocks are merged.
    """
    dim = centroids.shape[1] if centroids.size else 0
    rows = queries.select(query_key, vector).filter(F.col(vector).isNotNull()).limit(2).collect()
    if len(rows) <= 1:
        cells = probed(np.array(rows[0][vector], float), centroids, probes) if rows and len(rows[0][vector]) == dim else []
        return knn.top_k(indexed.filter(F.col("cell").isin(cells)) if cells else indexed.limit(0), queries, k, key=key, vector=vector, query_key=query_key, exclude_self=exclude_self, dim=dim)
    # one number per cell
    blocks = np.ones(len(centroids), int)
    for r in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect():
        blocks[r["cell"]] = -(-r["n"] // block)
    kind = dict(queries.dtypes)[query_key]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, q = knn._matrix(batch[vector], dim)
            best = np.argsort(-(q @ centroids.T), axis=1, kind="stable")[:, : max(1, probes)]
            who, cell = np.repeat(at, best.shape[1]), best.ravel()
            each = blocks[cell]
            take = pa.array(np.repeat(who, each))
            part = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            yield pa.RecordBatch.from_arrays([batch[query_key].take(take), batch[vector].take(take), pa.array(np.repeat(cell, each), pa.int32()), pa.array(part, pa.int32())], [query_key, vector, "cell", "block"])

    asked = queries.select(query_key, vector).filter(F.col(vector).isNotNull()).mapInArrow(spread, f"`{query_key}` {kind}, `{vector}` {dict(queries.dtypes)[vector]}, cell int, block int")
    large = {int(c): int(blocks[c]) for c in np.flatnonzero(blocks > 1)}
    of = F.coalesce(F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("cell")], F.lit(1)) if large else F.lit(1)
    data = indexed.select(key, vector, "cell", F.pmod(F.xxhash64(key), of).cast("int").alias("block"))
    return knn.ranked(knn.grouped(data, asked, ["cell", "block"], k, dim, key, vector, query_key, exclude_self), k, key, query_key)
