"""Listings of files: what a directory page offers, and what of it still has to be fetched."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: names of the files that a directory page offers.
FILE_NAME = r"^.+\.xml\.gz$"


def links(html: Column | str) -> Column:
    """The different link targets of a page that name files, sorted. A null page has none."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), 1)
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.rlike(FILE_NAME) & ~x.startswith("..")))), F.array().cast("array<string>"))


def listed_files(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """name and url of the files of all directory pages, each once."""
    base = F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/"))
    return pages.select(base.alias("base"), F.explode(links(html)).alias("name")).select("name", F.concat("base", "name").alias("url")).distinct()


def local_files(folder: str) -> list[str]:
    return sorted(str(p) for p in Path(folder).glob("*.xml.gz"))


def to_fetch(remote: DataFrame, local: DataFrame, *, force: bool = False) -> DataFrame:
    """Remote files (name, size) that are absent locally, of unknown remote size, or of another size; all with force."""
    both = remote.join(local.select("name", F.col("size").alias("local_size")), "name", "left")
    return both.filter(F.lit(force) | F.col("local_size").isNull() | F.col("size").isNull() | (F.col("size") != F.col("local_size"))).drop("local_size")


@dataclass
class Fetched:
    checked: int = 0
    saved: int = 0
    skipped: int = 0
    failed: int = 0


def fetch(files: Iterable[tuple[str, int | None]], folder: str, read: Callable[[str], bytes | Iterator[bytes]], *, force: bool = False, workers: int = 8, limit: int | None = None) -> Fetched:
    """Writes files (name, remote size) through a partial file that is renamed; a failed one leaves nothing behind.

    read gives the content of a name, whole or in pieces. This is one task's part of a download.
    """
    out, jobs = Fetched(), []
    for name, size in sorted(files)[: limit if limit is not None else None]:
        out.checked += 1
        target = Path(folder) / name
        if force or size is None or not target.exists() or target.stat().st_size != size:
            jobs.append((name, target))
        else:
            out.skipped += 1

    def one(job: tuple[str, Path]) -> bool:
        name, target = job
        part = target.with_name(target.name + ".part")
        try:
            content = read(name)
            with part.open("wb") as f:
                for piece in [content] if isinstance(content, bytes) else content:
                    f.write(piece)
            os.replace(part, target)
            return True
        except Exception:
            part.unlink(missing_ok=True)
            return False

    with ThreadPoolExecutor(max(1, workers)) as pool:
        for ok in pool.map(one, jobs):
            out.saved += ok
            out.failed += not ok
    return out
