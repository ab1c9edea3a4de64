"""Files of a server: listing its directory pages, asking for sizes, and fetching into a folder that all tasks share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib import error, request

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.listing import Fetched, fetch, listed_files

_PIECE = 1 << 20


def pieces(url: str, timeout: float = 60) -> Iterator[bytes]:
    """The content behind an address, a piece at a time."""
    with request.urlopen(url, timeout=timeout) as f:
        while piece := f.read(_PIECE):
            yield piece


def remote_size(url: str, timeout: float = 60) -> int | None:
    """What the server says of the size, without sending the content; None if it says nothing."""
    try:
        with request.urlopen(request.Request(url, method="HEAD"), timeout=timeout) as f:
            return int(f.headers.get("Content-Length") or "")
    except (OSError, ValueError):
        return None


def listed(spark: SparkSession, urls: Sequence[str]) -> DataFrame:
    """name and url of the files on these directory pages, each name once: the first page that has it counts."""
    pages = [(i, u, b"".join(pieces(u)).decode(errors="replace")) for i, u in enumerate(urls)]
    df = spark.createDataFrame([p[1:] for p in pages], "url string, html string")
    order = spark.createDataFrame([(i, u.rstrip("/") + "/") for i, u, _ in pages], "page int, base string")
    files = listed_files(df).withColumn("base", F.expr("left(url, length(url) - length(name))")).join(F.broadcast(order), "base")
    return files.groupBy("name").agg(F.min(F.struct("page", "url")).alias("f")).select("name", "f.url")


def download(files: DataFrame, folder: str, *, force: bool = False, workers: int = 8, limit: int | None = None, size: Callable[[str], int | None] = remote_size, read: Callable[[str], Iterator[bytes]] = pieces) -> Fetched:
    """Fetches files (name, url) into the folder, in as many tasks as workers; a file that is there with the remote size is left.

    The folder must be one path for all executors. limit takes the first names only.
    """
    files = files.select("name", "url")
    files = files if limit is None else files.orderBy("name").limit(limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = dict(zip(batch["name"], batch["url"]))
            done = fetch([(n, None if force else size(u)) for n, u in at.items()], folder, lambda n: read(at[n]), force=force, workers=1)
            yield pd.DataFrame([vars(done)])

    counts = files.repartition(max(1, workers)).mapInPandas(run, "checked int, saved int, skipped int, failed int")
    row = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("int").alias(c) for c in ("checked", "saved", "skipped", "failed")]).first()
    return Fetched(**row.asDict())


def refetcher(urls: Sequence[str], read: Callable[[str], Iterator[bytes]] = pieces) -> Callable[[str], None]:
    """A function that replaces a file by what one of the directories has under its name.

    A directory that doesn't have the file, or fails to answer, is followed by the next; another status than 404 raises.
    """

    def refetch(path: str) -> None:
        folder, _, name = path.removeprefix("file://").rpartition("/")
        last: Exception | None = None
        for url in urls:
            try:
                content = list(read(f"{url.rstrip('/')}/{name}"))
            except error.HTTPError as e:
                if e.code != 404:
                    raise
                last = e
            except OSError as e:
                last = e
            else:
                if fetch([(name, None)], folder, lambda _: iter(content), force=True, workers=1).saved:
                    return
        raise OSError(f"no directory has {name}: {last}")

    return refetch
