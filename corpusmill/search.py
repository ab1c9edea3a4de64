"""Free-text search: embed the query, find the nearest vectors, add what is known of them, show the hits."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.embedding import Embedder
from corpusmill.functions.text import preview
from corpusmill.operators import ivf, knn
from corpusmill.session import checkpointed
from corpusmill.store import Table, VectorStore


@dataclass(frozen=True)
class Choice:
    """Which index a search uses, and why not the other one."""

    kind: str
    warning: str | None = None


def _whole(v: object) -> int | None:
    try:
        return int(str(v).strip())
    except ValueError:
        return None


def select_index(properties: dict[str, str], index: dict[str, str] | None, *, flat_only: bool = False, flat_exists: bool = True) -> Choice:
    """The cells if they were built from the vectors as they are now, else all vectors with a warning.

    index has the properties of the cells, None if there are none. What isn't known of the vectors is taken as equal.
    """
    if flat_only or index is None:
        return Choice("flat")
    dim, total = _whole(index.get("built_from_dim")), _whole(index.get("built_from_ntotal"))
    now_dim, now_total = _whole(properties.get("dim")), _whole(properties.get("ntotal"))
    wish = (properties.get("query_index_type") or "").strip().lower()
    if dim is None or total is None:
        why = "its metadata is missing"
    elif now_dim is not None and now_dim != dim:
        why = f"it has dimension {dim}, the vectors have {now_dim}"
    elif now_total is not None and now_total != total:
        why = f"it was built from {total} vectors, there are {now_total}"
    elif wish and wish != "ivf":
        why = f"the store asks for {wish}"
    else:
        return Choice("ivf")
    if not flat_exists:
        raise RuntimeError(f"the index can't be used: {why}")
    return Choice("flat", f"The index can't be used: {why}. Falling back to flat index.")


def build_index(spark: SparkSession, store: VectorStore, index_root: str, params: ivf.Params = ivf.Params(), *, force: bool = False) -> dict:
    """Writes the vectors by cell, with the centroids in the manifest, and makes the store ask for it."""
    table = Table(spark, index_root)
    if table.exists() and not force:
        raise FileExistsError(f"{index_root} exists; force replaces it")
    vectors, known = store.read(), store.properties()
    centroids, probes = ivf.build(vectors, params)
    m = table.overwrite(
        ivf.assign(vectors, centroids),
        {"built_from_dim": known["dim"], "built_from_ntotal": known["ntotal"], "probes": probes, "cells": len(centroids), "centroids": json.dumps(centroids.tolist())},
        partition_by=["cell"],
    )
    store.commit(lambda m: m["parts"], {"query_index_type": "ivf"})
    return m


def hits(spark: SparkSession, vectors: DataFrame, articles: DataFrame, query: Sequence[float], *, k: int = 10, preview_chars: int = 280, centroids: np.ndarray | None = None, probes: int | None = None) -> DataFrame:
    """rank, pmid, score, title, abstract_preview, year, journal of the best vectors; unknown articles keep their hit.

    With centroids vectors are those of the index, of which only the nearest cells are read.
    """
    q = spark.createDataFrame([(0, [float(x) for x in query])], "qid int, embedding array<double>").withColumn("embedding", knn.normalized("embedding"))
    found = knn.top_k(vectors, q, k, dim=len(query)) if centroids is None else ivf.search(vectors, centroids, q, k, probes or len(centroids))
    # k rows, however many vectors and articles there are; written once, since two joins read them
    few = F.broadcast(checkpointed(found.drop("qid")))
    known = articles.join(few.select("pmid"), "pmid", "left_semi")
    return knn.hydrated(few, known).select("rank", "pmid", "score", "title", preview("abstract", preview_chars).alias("abstract_preview"), "year", "journal").orderBy("rank")


def search(spark: SparkSession, articles: DataFrame, store: VectorStore, index_root: str | None, text: str, embedder: Embedder, *, source: str, k: int = 10, preview_chars: int = 280, probes: int | None = None, flat_only: bool = False, model: str | None = None) -> tuple[DataFrame, Choice]:
    """The hits of a text and the index that gave them. Blank text, another source or another dimension raise first."""
    if not text.strip():
        raise ValueError("the query is blank")
    if probes is not None and probes < 1:
        raise ValueError("probes is 1 at least")
    known = store.properties()
    if known.get("embedding_source", source) != source:
        raise ValueError(f"the vectors were made by {known['embedding_source']}, the query by {source}")
    index = Table(spark, index_root) if index_root else None
    there = index is not None and index.exists()
    choice = select_index(known, index.properties() if there else None, flat_only=flat_only, flat_exists=store.exists())
    vector = np.asarray(embedder([text]), float)[0]
    if _whole(known.get("dim")) not in (None, len(vector)):
        raise ValueError(f"the query has dimension {len(vector)}, the vectors have {known['dim']}")
    if choice.kind == "flat":
        return hits(spark, store.read(), articles, vector, k=k, preview_chars=preview_chars), choice
    p = index.properties()
    return hits(spark, index.read(), articles, vector, k=k, preview_chars=preview_chars, centroids=np.array(json.loads(p["centroids"])), probes=probes or _whole(p.get("probes")) or None), choice


def render_text(rows: list, kind: str) -> str:
    """Hits for reading."""
    if not rows:
        return f"Index: {kind}\nNo results."
    blocks = []
    for r in rows:
        about = " | ".join(str(x) for x in (r["year"], r["journal"]) if x not in (None, ""))
        lines = [f"{r['rank']}. PMID {r['pmid']}  score={r['score']:.4f}", about, r["title"] and f"Title: {r['title']}", r["abstract_preview"] and f"Abstract: {r['abstract_preview']}"]
        blocks.append("\n   ".join(x for x in lines if x))
    return "\n\n".join([f"Index: {kind}", *blocks])


def render_json(rows: list, kind: str) -> str:
    return json.dumps({"index_type": kind, "hits": [r.asDict() for r in rows]}, ensure_ascii=False, indent=2)
