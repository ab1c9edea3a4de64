"""Filling containers of fixed capacity with documents.

The plan is made from the histogram of sizes alone, whose length is bounded by the capacity and not by the data: pieces
above a third of the capacity are matched greedily, largest first with the largest partner that still fits (no more than
two of them fit into one container), and smaller ones go, largest first, into the tightest gaps that are left. The plan
is a list of slots "ranks lo to hi of size s go into containers from c on, m to each". Pieces then find their container
by their rank among the pieces of their size. Ranks are found by salting: rows are ranked within (size, salt) groups of
bounded size and shifted by the counts of the groups before, so that no size, however frequent, is one task's work.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import checkpointed

#: Rows that one task ranks at once, on average.
_GROUP = 20_000

Slot = tuple[int, int, int, int, int]  # size, first rank, end of ranks, first container, pieces per container


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Slot], int]:
    """The slots and the number of containers for so many pieces of each size from 1 to capacity."""
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("sizes must be between 1 and the capacity")
    left = {s: n for s, n in histogram.items() if n > 0}
    taken: dict[int, int] = defaultdict(int)
    slots: list[Slot] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> ranges (first container, number)
    opened = 0

    def take(size: int, containers: int, first: int, each: int = 1) -> None:
        n = min(containers * each, left[size])
        slots.append((size, taken[size], taken[size] + n, first, each))
        taken[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]

    # matching of the large: at most two per container
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        if s not in left:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - s) - 1
        while at >= 0 and large[at] not in left:
            del large[at]
            at -= 1
        if at >= 0 and large[at] == s and left[s] == 1:  # the last of its size looks for a smaller partner
            at -= 1
            while at >= 0 and large[at] not in left:
                at -= 1
        partner = large[at] if at >= 0 else None
        if partner is None:
            n = left[s]
            take(s, n, opened)
            gaps[capacity - s].append((opened, n))
        elif partner == s:
            n = left[s] // 2
            take(s, n, opened, 2)
            gaps[capacity - 2 * s].append((opened, n))
        else:
            n = min(left[s], left[partner])
            take(s, n, opened)
            take(partner, n, opened)
            gaps[capacity - s - partner].append((opened, n))
        opened += n

    # best fit of the small into the gaps
    free = sorted(g for g in gaps if g > 0)
    for s in sorted((s for s in left), reverse=True):
        while s in left:
            at = bisect.bisect_left(free, s)
            if at == len(free):
                each = capacity // s
                n = -(-left[s] // each)
                first, opened = opened, opened + n
                gap = capacity
            else:
                gap = free[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del free[at]
                each = gap // s
            need = -(-left[s] // each)
            if n > need:
                if not gaps[gap]:
                    bisect.insort(free, gap)
                gaps[gap].append((first + need, n - need))
                n = need
            rest = left[s] - (n - 1) * each if left[s] < n * each else each
            take(s, n, first, each)
            for space, start, count in ((gap - each * s, first, n - 1), (gap - min(rest, each) * s, first + n - 1, 1)):
                if space > 0 and count > 0:
                    if not gaps[space]:
                        bisect.insort(free, space)
                    gaps[space].append((start, count))
    return slots, opened


def pieces_of(sizes: DataFrame, capacity: int, *, key: str, size: str) -> DataFrame:
    """key, piece_no, first, size: whole documents, or for larger ones full pieces and a rest. Sizes of 0 or null give none."""
    n = F.col(size)
    parts = F.sequence(F.lit(0), F.ceil(n / capacity).cast("int") - 1)
    split = sizes.filter(n > 0).select(F.col(key).alias("key"), n.cast("bigint").alias("total"), F.explode(parts).alias("piece_no"))
    first = F.col("piece_no").cast("bigint") * capacity
    return split.select("key", "piece_no", first.alias("first"), F.least(F.lit(capacity), F.col("total") - first).cast("int").alias("size"))


def ranked(pieces: DataFrame, *, group: int = _GROUP) -> DataFrame:
    """pieces with rank, from 0 and without gaps within each size; equal keys and piece numbers share any order."""
    n = pieces.count()
    salt = F.pmod(F.xxhash64("key", "piece_no"), F.lit(max(1, -(-n // group)))).cast("int")
    salted = pieces.withColumn("salt", salt)
    counts = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = salted.withColumn("at", F.row_number().over(Window.partitionBy("size", "salt").orderBy("key", "piece_no")))
    return within.join(shifts, ["size", "salt"]).select("key", "piece_no", "first", "size", (F.col("shift") + F.col("at") - 1).alias("rank"))


def pack(sizes: DataFrame, capacity: int, *, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """key, piece_no, first, n_tokens, bin_id: every document in a container, none of which holds more than capacity.

    Only documents above the capacity are split, into full pieces and a rest; piece_no counts from 0 and first is the
    offset of the piece. Null, zero and negative sizes are left out; rows with equal keys are packed each. No rows give none.
    """
    kind = dict(sizes.select(key).dtypes)[key]
    pieces = checkpointed(pieces_of(sizes, capacity, key=key, size=size))
    histogram = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count("*").alias("n")).toLocalIterator()}
    slots, _ = plan(histogram, capacity)
    spark = sizes.sparkSession
    # bounded by the capacity: some thousands of slots, whatever the number of documents
    table = spark.createDataFrame(slots, "size int, lo bigint, hi bigint, container bigint, each bigint")
    by_size = table.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "container", "each"))).alias("slots"))
    placed = ranked(pieces).join(F.broadcast(by_size), "size")
    slot = F.get(F.filter("slots", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"])), 0)
    return placed.withColumn("slot", slot).select(
        F.col("key").cast(kind).alias(key), "piece_no", F.col("first").alias("first_token"), F.col("size").alias("n_tokens"),
        (F.col("slot.container") + F.floor((F.col("rank") - F.col("slot.lo")) / F.col("slot.each"))).cast("bigint").alias("bin_id"),
    )


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: bins, tokens, lower_bound (containers that any packing needs by volume) and fill, the used share."""
    bins = packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("used"))
    tokens: Column = F.sum("used")
    return bins.agg(F.count("*").alias("bins"), F.coalesce(tokens, F.lit(0)).alias("tokens"), F.coalesce(F.ceil(tokens / capacity), F.lit(0)).alias("lower_bound"), F.round(tokens / (F.count("*") * capacity), 6).alias("fill"))


def unsound(sizes: DataFrame, capacity: int, *, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """key, bin_id, n_tokens of what is wrong with the packing of these sizes: a container above the capacity (key null), or a
    document whose pieces don't have its size, or that is split although it would fit (bin_id null). No rows if it is sound.
    """
    packed = checkpointed(pack(sizes, capacity, key=key, size=size))
    none = F.lit(None).cast("bigint")
    over = packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("n_tokens")).filter(F.col("n_tokens") > capacity).select(none.alias(key), "bin_id", "n_tokens")
    whole = sizes.filter(F.col(size) > 0).groupBy(key).agg(F.sum(size).alias("wanted"), F.count("*").alias("rows"), F.max(size).alias("largest"))
    got = packed.groupBy(key).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("pieces"))
    wrong = whole.join(got, key, "full").filter(~F.col("wanted").eqNullSafe(F.col("n_tokens")) | ((F.col("largest") <= capacity) & (F.col("pieces") > F.col("rows"))))
    return over.unionByName(wrong.select(F.col(key).cast("bigint").alias(key), none.alias("bin_id"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")))
