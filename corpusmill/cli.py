"""Command line: python -m corpusmill.cli download|ingest|profile|embed|index|query|benchmark ... under a data folder.

Exit codes: 0 done, 1 failed or nothing there, 2 wrong arguments, 130 stopped.
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from pathlib import Path

import numpy as np
from pyspark.sql import SparkSession

from corpusmill import embedding, search
from corpusmill.ingest import ingest
from corpusmill.operators import ivf, stats
from corpusmill.session import local_session
from corpusmill.sources import remote
from corpusmill.sources.listing import local_files
from corpusmill.store import KeyedTable, Table, VectorStore, merge_shards, shards


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusmill", description=__doc__)
    p.add_argument("--data-dir", default="data")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("download", help="fetch the files that directory pages list")
    a.add_argument("--url", action="append", required=True)
    a.add_argument("--limit", type=int)
    a.add_argument("--force", action="store_true")
    a.add_argument("--workers", type=int, default=8)
    a = sub.add_parser("ingest", help="take files of changes into the article table")
    a.add_argument("--files", nargs="*")
    a.add_argument("--no-resume", action="store_true")
    a.add_argument("--delete-scope", choices=("first", "all"), default="first")
    a.add_argument("--on-corrupt", choices=("fail", "quarantine"), default="fail")
    a.add_argument("--refetch-url", action="append", help="directories that corrupt files are fetched from again, in this order")
    a = sub.add_parser("profile", help="counts, years and words of the articles")
    a.add_argument("--out-dir")
    a.add_argument("--word-bins", type=int, default=30)
    a.add_argument("--word-max", type=int)
    for name in ("embed", "index", "query", "benchmark"):
        a = sub.add_parser(name)
        a.add_argument("--model", default=os.environ.get("EMBEDDING_MODEL"))
        a.add_argument("--source", default=os.environ.get("EMBEDDING_SOURCE", "hashing"))
        a.add_argument("--base-url", default=os.environ.get("TEI_BASE_URLS") or os.environ.get("TEI_BASE_URL") or os.environ.get("OLLAMA_BASE_URL", "http://127.0.0.1:11434"))
        if name == "embed":
            a.add_argument("--limit", type=int)
            a.add_argument("--shard-id", type=int)
            a.add_argument("--num-shards", type=int)
            a.add_argument("--checkpoint-every", type=int)
            a.add_argument("--workers", type=int, default=1, help="shards that are embedded at the same time")
            a.add_argument("--no-auto-merge", action="store_true")
            a.add_argument("--merge-shards", action="store_true", help="only bring the shards' vectors together")
        if name == "index":
            a.add_argument("--cells", type=int, help="by default as many as the vectors need")
            a.add_argument("--probes", type=int, help="by default as many as reach the recall")
            a.add_argument("--force", action="store_true")
        if name == "query":
            a.add_argument("query", nargs="+")
            a.add_argument("--top-k", type=int, default=10)
            a.add_argument("--abstract-chars", type=int, default=280)
            a.add_argument("--probes", type=int)
            a.add_argument("--flat-only", action="store_true")
            a.add_argument("--json", action="store_true")
        if name == "benchmark":
            a.add_argument("--batch-size", type=int, default=32)
            a.add_argument("--batches", type=int, default=20)
            a.add_argument("--warmup", type=int, default=3)
            a.add_argument("--against", help="another source, whose speed is compared")
        a.add_argument("--local-device", default=os.environ.get("LOCAL_EMBED_DEVICE"), help="of the local provider; by default the GPU if there is one")
    return p


def _make(a: argparse.Namespace):
    """A function that makes the named provider for a task."""
    source, urls, model = embedding.provider_name(a.source), [u for u in a.base_url.split(",") if u], a.model
    if source == "hashing":
        return lambda _: embedding.HashingEmbedder()
    if source == "tei-http":
        path, token, cut = os.environ.get("TEI_EMBED_PATH", "/embed"), os.environ.get("TEI_API_KEY") or os.environ.get("HF_TOKEN"), os.environ.get("TEI_TRUNCATE", "true").lower() != "false"
        return lambda task: embedding.BatchServer(embedding.http_post(embedding.endpoint(urls, task)), path, token, cut)
    if source == "ollama":
        return lambda task: embedding.SingleServer(embedding.http_post(embedding.endpoint(urls, task)), model)
    try:
        from sentence_transformers import SentenceTransformer
    except ImportError:
        raise ValueError("the local provider needs sentence_transformers, which isn't installed") from None

    def local(_):
        m = SentenceTransformer(embedding.model_name(model), device=a.local_device)
        if str(m.device).startswith("cuda"):
            m.half()  # half precision pays on a GPU only
        return lambda texts: m.encode(list(texts))

    return local


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    try:
        a = _parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    root = Path(a.data_dir)
    say = lambda *x: print(*x, file=sys.stderr)
    if a.command in ("embed", "index", "query", "benchmark") and not a.model:
        say("--model or EMBEDDING_MODEL is needed")
        return 2
    try:
        make = _make(a) if a.command in ("embed", "query", "benchmark") else None
        shard = None
        if a.command == "embed" and (a.shard_id is not None or a.num_shards is not None):
            if a.shard_id is None or a.num_shards is None or not 0 <= a.shard_id < a.num_shards:
                raise ValueError("--shard-id and --num-shards go together, 0 <= id < number")
            shard = a.shard_id, a.num_shards
        if a.command == "embed" and (a.workers < 1 or (a.workers > 1 and shard)):
            raise ValueError("--workers is 1 at least, and 1 with --shard-id")
        params = ivf.Params(a.cells, a.probes) if a.command == "index" else None
        if a.command == "query" and not " ".join(a.query).strip():
            raise ValueError("the query is blank")
    except ValueError as e:
        say(e)
        return 2
    try:
        if a.command == "benchmark":
            return _benchmark([make(0), *([_make(argparse.Namespace(**vars(a) | {"source": a.against}))(0)] if a.against else [])], a)
        spark = spark or local_session()
        articles = KeyedTable(spark, str(root / "articles"), "pmid")
        if a.command == "download":
            root.mkdir(parents=True, exist_ok=True)
            done = remote.download(remote.listed(spark, a.url), str(root), force=a.force, workers=max(1, a.workers), limit=a.limit)
            print(vars(done))
            return 1 if done.failed else 0
        if a.command == "ingest":
            files = a.files if a.files is not None else local_files(str(root))
            if not files:
                say("no files")
                return 1
            print(ingest(spark, str(root), files, resume=not a.no_resume, delete_scope=a.delete_scope, on_corrupt=a.on_corrupt, refetch=remote.refetcher(a.refetch_url) if a.refetch_url else None))
            return 0
        if a.command == "profile":
            return _profile(articles, root, a)
        place = root / "vectors" / embedding.slug(a.model)
        store, index = VectorStore(spark, str(place)), str(root / "index" / embedding.slug(a.model))
        if a.command == "embed":
            return _embed(spark, articles, store, make, shard, a)
        if a.command == "index":
            m = search.build_index(spark, store, index, params, force=a.force)
            print({k: v for k, v in m["properties"].items() if k != "centroids"})
            return 0
        found, choice = search.search(spark, articles.read(), store, index, " ".join(a.query), make(0), source=a.source, k=max(1, a.top_k), preview_chars=a.abstract_chars, probes=a.probes, flat_only=a.flat_only)
        if choice.warning:
            say(choice.warning)
        print((search.render_json if a.json else search.render_text)(found.collect(), choice.kind))
        return 0
    except Exception as e:
        say(f"{type(e).__name__}: {str(e)[:500]}")
        return 1


def _embed(spark: SparkSession, articles: Table, store: VectorStore, make, shard: tuple[int, int] | None, a: argparse.Namespace) -> int:
    parts, model = f"{store.root}/{embedding.SHARDS}", {"embedding_source": a.source, "model": a.model}
    if not a.merge_shards:
        stop = embedding.StopOnSignal()
        every = a.checkpoint_every or (embedding.CHUNK_SINGLE if a.source == "ollama" else embedding.CHUNK_BATCHED)
        # a model that is loaded stays in its worker; a connection is made anew
        job = {"source": a.source, "model": a.model, "chunk": every, "limit": a.limit, "stop": stop, "keep_as": f"local {a.model}" if a.source == "local" else None}
        if a.workers > 1:
            print("embedded", *embedding.embed_in_shards(articles.read(), spark, store.root, lambda n: (lambda task: make(n)), a.workers, **job))
        else:
            held = [store.ids()] if store.manifest()["parts"] else []
            # a shard of its own has a store of its own, so that jobs on several machines never share one
            target = VectorStore(spark, f"{parts}/{shard[0]}") if shard else store
            n = embedding.embed_pending(articles.read(), target, (lambda task: make(shard[0])) if shard else make, shard=shard, also_done=held if shard else (), **job)
            print(f"embedded {n}")
        if stop.seen:
            return 130
        if a.workers == 1 or a.no_auto_merge:
            return 0
    found = shards(spark, parts)
    if not found:
        print("no shard has vectors", file=sys.stderr)
        return 1
    print("merged", merge_shards(store, [s.read() for s in found], properties=model)["properties"]["ntotal"])
    return 0


def _profile(articles: Table, root: Path, a: argparse.Namespace) -> int:
    df = articles.read()
    out = Path(a.out_dir or root / "profile")
    out.mkdir(parents=True, exist_ok=True)
    (out / "summary.txt").write_text(stats.summary(df))
    # one row per year and per bin, never per article
    stats.per_year(df).orderBy(stats.F.col("year").try_cast("int").asc_nulls_last()).toPandas().to_csv(out / "articles_by_year.csv", index=False)
    stats.word_histogram(df, bins=a.word_bins, cap=a.word_max).orderBy("bin").toPandas().to_csv(out / "words.csv", index=False)
    print((out / "summary.txt").read_text(), end="")
    return 0


def _benchmark(embedders: list, a: argparse.Namespace) -> int:
    texts = [f"short text number {i} about the outcome of treatment" for i in range(a.batch_size)]
    rates = []
    for embedder in embedders:
        for _ in range(a.warmup):
            embedder(texts)
        times = []
        for _ in range(max(1, a.batches)):
            t = time.perf_counter()
            embedder(texts)
            times.append(time.perf_counter() - t)
        rates.append(len(times) * a.batch_size / sum(times))
        print(f"{rates[-1]:.1f} texts/s, median batch {np.median(times) * 1000:.2f} ms")
    if len(rates) > 1:
        print(f"ratio {rates[0] / rates[1]:.2f}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
