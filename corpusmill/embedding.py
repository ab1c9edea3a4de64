"""Embedding pending texts: providers, and a job that can be stopped and taken up again at any point."""

from __future__ import annotations

import json
import os
import re
import signal
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import prompt
from corpusmill.operators.pending import pending
from corpusmill.store import VectorStore

# Model names, tried as given and then in lower case; lengths that a server that rejects a text is offered.
ALIASES = {"bge-large-en-v1.5": "BAAI/bge-large-en-v1.5", "sentence-transformers/bge-large-en-v1.5": "BAAI/bge-large-en-v1.5"}
SHORTER = (262144, 131072, 65536, 32768, 16384, 8192, 4096)
#: Chunk sizes of one commit: for providers that take batches, and for those that take texts one at a time.
CHUNK_BATCHED, CHUNK_SINGLE = 5000, 50

#: Folder of the shards' stores below a store.
SHARDS = "shards"

Post = Callable[[str, dict, dict], tuple[int, object]]  # path, body, headers -> status, decoded answer


class Embedder(Protocol):
    """Made anew in every Python worker, so it may hold what can't be sent."""

    name: str

    def __call__(self, texts: Sequence[str]) -> np.ndarray: ...


@dataclass
class HashingEmbedder:
    """Signed counts of words by hash, of unit length: the same on every machine, for tests and as a baseline."""

    dim: int = 64
    name: str = "hashing"

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        words = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
        row = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        out = np.zeros(len(texts) * self.dim)
        if len(row):
            h = pd.util.hash_array(np.array([w for ws in words for w in ws], object), categorize=False)
            at = row * self.dim + (h % np.uint64(self.dim)).astype(np.int64)
            out += np.bincount(at, np.where((h >> np.uint64(32)) & np.uint64(1), 1.0, -1.0), len(out))
        return out.reshape(len(texts), self.dim)


def vectors_in(answer: object, expected: int) -> np.ndarray:
    """Rows of a server's answer: a list of lists, {"embeddings": ...}, or one flat vector where one row is expected."""
    rows = answer.get("embeddings", answer.get("embedding")) if isinstance(answer, dict) else answer
    if not isinstance(rows, list) or not rows:
        raise ValueError(f"no vectors in the answer: {str(answer)[:200]}")
    if not isinstance(rows[0], list):
        if expected != 1:
            raise ValueError("one flat vector for several texts")
        rows = [rows]
    out = np.asarray(rows, np.float64)
    if out.ndim != 2 or len(out) != expected or not out.shape[1]:
        raise ValueError(f"{out.shape} vectors for {expected} texts")
    return out


@dataclass
class BatchServer:
    """A server that takes a list of texts."""

    post: Post
    path: str = "/embed"
    token: str | None = None
    truncate: bool = True
    name: str = "tei-http"

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        status, answer = self.post(self.path, {"inputs": list(texts), "truncate": self.truncate}, {"Authorization": f"Bearer {self.token}"} if self.token else {})
        if status != 200:
            raise RuntimeError(f"status {status}: {answer}")
        return vectors_in(answer, len(texts))


@dataclass
class SingleServer:
    """A server that takes one text, with an older path for servers that lack the newer one.

    A rejected text (400) is offered with other truncation flags, then shorter and shorter.
    """

    post: Post
    model: str = ""
    name: str = "ollama"

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        return np.vstack([self._one(t) for t in texts])

    def _one(self, text: str) -> np.ndarray:
        answer: object = None
        for part in dict.fromkeys([text, *(text[:n] for n in SHORTER if n < len(text))]):
            for flag in (True, None, False):
                status, answer = self.post("/api/embed", {"model": self.model, "input": part} | ({} if flag is None else {"truncate": flag}), {})
                if status == 404:
                    status, answer = self.post("/api/embeddings", {"model": self.model, "prompt": part}, {})
                if status == 200:
                    return vectors_in(answer, 1)
                if status != 400:
                    raise RuntimeError(f"status {status}: {answer}")
        raise RuntimeError(f"rejected at every length: {answer}")


def http_post(base: str, timeout: float = 120) -> Post:
    """Posts JSON to a server with the standard library."""
    from urllib import error, request

    def post(path: str, body: dict, headers: dict) -> tuple[int, object]:
        r = request.Request(base.rstrip("/") + path, json.dumps(body).encode(), {"Content-Type": "application/json"} | headers)
        try:
            with request.urlopen(r, timeout=timeout) as f:
                return f.status, json.loads(f.read() or b"null")
        except error.HTTPError as e:
            return e.code, e.read().decode(errors="replace")

    return post


def endpoint(urls: Sequence[str], number: int) -> str:
    """The server of a task or shard."""
    return urls[number % len(urls)]


def provider_name(name: str) -> str:
    """A known provider's name, or ValueError."""
    if name not in ("ollama", "local", "tei-http", "hashing"):
        raise ValueError(f"unknown provider {name!r}: use ollama, local, tei-http or hashing")
    return name


def model_name(name: str) -> str:
    name = name.strip()
    return ALIASES.get(name) or ALIASES.get(name.lower()) or name


def slug(name: str) -> str:
    """A folder name for a model."""
    return re.sub(r"[^a-zA-Z0-9._-]+", "-", name).strip("-").lower() or "model"


def batch_size(given: int | None = None) -> int:
    found = [os.environ.get(v, "") for v in ("LOCAL_EMBED_BATCH_SIZE", "TEI_BATCH_SIZE")]
    return max(1, given if given is not None else next((int(v) for v in found if v.isdigit()), 32))


def max_chars() -> int | None:
    v = os.environ.get("EMBEDDING_MAX_INPUT_CHARS", "")
    return int(v) if v.isdigit() else None


#: Models of this Python worker by name, so that a model is loaded once and not once per task.
MODELS: dict[str, Embedder] = {}


def embed(df: DataFrame, make: Callable[[int], Embedder], *, key: str = "pmid", text: str = "prompt", batch: int | None = None, on_empty: str = "error", keep_as: str | None = None) -> DataFrame:
    """key and embedding (unit length) of the texts. make is called once per task with the partition's number, or with
    keep_as once per Python worker, which keeps the model under this name.

    A null or empty text raises, or with on_empty="skip" gives no row.
    """
    if on_empty not in ("error", "skip"):
        raise ValueError("on_empty is error or skip")
    size = batch_size(batch)
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from corpusmill import embedding  # the worker's own module, not a copy that travels with this function

        model = embedding.MODELS.get(keep_as) if keep_as else None
        for rows in batches:
            full = rows[rows[text].map(lambda t: isinstance(t, str) and t != "")]
            if len(full) < len(rows) and on_empty == "error":
                raise ValueError(f"empty text to embed, key {rows[key][~rows.index.isin(full.index)].iloc[0]}")
            for a in range(0, len(full), size):
                part = full.iloc[a : a + size]
                if model is None:
                    model = make(TaskContext.get().partitionId())
                    if keep_as:
                        embedding.MODELS[keep_as] = model
                x = np.asarray(model(part[text].tolist()), np.float64)
                n = np.linalg.norm(x, axis=1, keepdims=True)
                x = np.divide(x, n, out=np.zeros_like(x), where=n > 0).astype(np.float32)
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": x.tolist()})

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, embedding array<float>")


#: Commits of one run at most: with more texts than so many chunks, chunks grow.
_COMMITS = 1_000


def embed_pending(
    articles: DataFrame, store: VectorStore, make: Callable[[int], Embedder], *, source: str, model: str, chunk: int = CHUNK_BATCHED, limit: int | None = None,
    shard: tuple[int, int] | None = None, on_empty: str = "error", stop: Callable[[], bool] = lambda: False, keep_as: str | None = None, also_done: Sequence[DataFrame] = (),
) -> int:
    """Embeds what is pending in chunks, each committed before the next begins; returns how many were added.

    What is to do is written once, in buckets of about chunk texts by the hash of the key; each chunk then reads its
    bucket only. A stopped or killed run loses the current chunk at most: the next one starts from what the store holds.
    also_done: further keys that aren't embedded again. Another source than the store's raises.
    """
    before = store.manifest()
    known = before["properties"]
    if known.get("embedding_source", source) != source:
        raise ValueError(f"the store was embedded by {known['embedding_source']}, not by {source}")
    # what is to do is found against these parts, and later chunks have other keys than the ones before
    absent = list(before["parts"])
    done = [*([store.ids()] if absent else []), *also_done]
    todo = pending(articles, *done, limit=limit, shard=shard).select("pmid", prompt("title", "abstract", max_chars()).alias("prompt"))
    name = f"_todo-{uuid.uuid4().hex}"
    n = todo.count()
    if not n:
        return 0
    buckets = -(-n // max(chunk, -(-n // _COMMITS)))
    spread = todo.withColumn("bucket", F.pmod(F.xxhash64("pmid"), F.lit(buckets)).cast("int"))
    # each bucket in several files, since its texts are embedded side by side
    tasks = F.pmod(F.xxhash64("pmid", F.lit(1)), F.lit(articles.sparkSession.sparkContext.defaultParallelism))
    spread.repartition("bucket", tasks).write.partitionBy("bucket").parquet(store.folder.path(name))
    added = 0
    try:
        for bucket in store.folder.names(name):
            if not bucket.startswith("bucket="):
                continue
            if stop():
                break
            rows = articles.sparkSession.read.parquet(store.folder.path(f"{name}/{bucket}"))
            m = store.add(embed(rows, make, on_empty=on_empty, keep_as=keep_as), properties={"embedding_source": source, "model": model}, absent_from=absent)
            added += m.get("added", 0)
            absent += m.get("named", [])
    finally:
        store.folder.delete(name)
    return added


def embed_in_shards(articles: DataFrame, spark: SparkSession, root: str, makes: Callable[[int], Callable[[int], Embedder]], workers: int, **job) -> list[int]:
    """Runs a job per shard at the same time, each into a store of its own below root; how many each has added.

    Shards never share a store, so they can't get in each other's way; merge_shards brings them together. Keys that the
    main store at root holds aren't embedded again. makes gives the providers of a shard. The first failure is raised
    when all have ended.
    """
    main = VectorStore(spark, root)
    held = [main.ids()] if main.manifest()["parts"] else []

    def one(number: int) -> int:
        store = VectorStore(spark, f"{root}/{SHARDS}/{number}")
        return embed_pending(articles, store, makes(number), shard=(number, workers), also_done=held, **job)

    with ThreadPoolExecutor(workers) as pool:
        return [f.result() for f in [pool.submit(one, i) for i in range(workers)]]


class StopOnSignal:
    """True after an interrupt or a request to end, for embed_pending's stop."""

    def __init__(self):
        self.seen = False
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, self._note)

    def _note(self, *_) -> None:
        self.seen = True

    def __call__(self) -> bool:
        return self.seen
