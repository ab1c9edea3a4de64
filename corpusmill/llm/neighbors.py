"""The k most similar vectors of every vector, by a forest of random-projection trees.

The trees are fitted on a bounded sample and split the space by hyperplanes between two random, refined centres. Every
vector lies in one leaf of each tree, and visits further leaves: the branches that it missed by the smallest margin,
taken from one priority queue over all trees. A leaf is one task's block: its vectors are compared with each other and
with its visitors by matrix products. Lists of the few visits of a vector are merged by its id, and reranked exactly:
vectors travel to the leaves in 16-bit steps, so where the order at the end of a list hangs on less than these steps can
tell, the original vectors are read again and decide. Leaves hold a bounded number of vectors however many there are,
since their number follows the table; where the sample can't tell so many leaves apart, a leaf's vectors are cut into
blocks. Equal vectors, which no hyperplane can part, are compared once and expanded afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import checkpointed

#: Rows up to which a list of ids is broadcast (16 bytes each).
_BROADCAST_ROWS = 500_000
#: Candidates beyond the k best that a list keeps for the exact ranking, and the difference of packed cosines up to which
#: it decides: six standard deviations of what packing does to a difference.
_MARGIN, _UNSURE = 1, 4e-5


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in one numbering; a leaf's children are itself."""

    normal: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray

    def leaves(self, x: np.ndarray, extra: int, reach: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Home leaves (rows x trees) and the leaves of the extra nearest branches not taken (rows x extra, -1 if none).

        One queue for all trees holds the branches by the margin by which they were missed; the nearest is taken and
        followed to its leaf, which adds the branches missed on that way. Branches missed by more than reach stay.
        """
        rows, trees = len(x), len(self.roots)
        cost = np.full((rows, 0), np.inf, np.float32)
        branch = np.zeros((rows, 0), np.int32)
        home = np.empty((rows, trees), np.int32)
        everyone = np.arange(rows)
        for t, root in enumerate(self.roots):
            home[:, t], c, b = self._follow(x, np.full(rows, root, np.int32), np.zeros(rows, np.float32))
            cost, branch = np.hstack([cost, c]), np.hstack([branch, b])
        visits = np.full((rows, extra), -1, np.int32)
        for v in range(extra):
            if not cost.shape[1]:
                break
            at = cost.argmin(axis=1)
            least = cost[everyone, at]
            go = np.isfinite(least) & (least <= reach)
            start = branch[everyone, at]
            cost[everyone, at] = np.inf
            leaf, c, b = self._follow(x, np.where(go, start, 0).astype(np.int32), least)
            visits[go, v] = leaf[go]
            c[~go] = np.inf
            cost, branch = np.hstack([cost, c]), np.hstack([branch, b])
        return home, visits

    def _follow(self, x: np.ndarray, node: np.ndarray, paid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        costs, branches = [], []
        while True:
            inner = self.left[node] != node
            if not inner.any():
                break
            margin = np.einsum("ij,ij->i", x, self.normal[node]) - self.offset[node]
            right = margin > 0
            costs.append(np.where(inner, np.maximum(np.abs(margin), paid), np.inf).astype(np.float32))
            branches.append(np.where(right, self.left[node], self.right[node]).astype(np.int32))
            node = np.where(inner, np.where(right, self.right[node], self.left[node]), node).astype(np.int32)
        if not costs:
            return node, np.full((len(x), 0), np.inf, np.float32), np.zeros((len(x), 0), np.int32)
        return node, np.stack(costs, 1), np.stack(branches, 1)


    def shares(self, sample: np.ndarray) -> np.ndarray:
        """The part of the sample in each node that is a leaf."""
        home, _ = self.leaves(sample, 0)
        return np.bincount(home.ravel(), minlength=len(self.left)) / max(1, len(sample))


def fit_forest(sample: np.ndarray, leaf_share: float, trees: int, seed: int = 7) -> Forest:
    """Trees over unit vectors, with leaves of at most leaf_share of the sample (4 vectors at least)."""
    rng = np.random.default_rng(seed)
    normal, offset, left, right, roots = [], [], [], [], []
    most = max(4, int(leaf_share * len(sample)))

    def node() -> int:
        normal.append(np.zeros(sample.shape[1], np.float32))
        offset.append(0.0)
        left.append(len(left))
        right.append(len(right))
        return len(left) - 1

    def split(rows: np.ndarray) -> tuple[np.ndarray, float] | None:
        part, best = sample[rows], None
        for _ in range(3):
            a, b = part[rng.choice(len(part), 2, replace=False)]
            for _ in range(3):
                side = part @ (a - b) > 0
                if side.all() or not side.any():
                    break
                a, b = part[side].mean(0), part[~side].mean(0)
                a, b = a / max(np.linalg.norm(a), 1e-9), b / max(np.linalg.norm(b), 1e-9)
            w = a - b
            size = np.linalg.norm(w)
            if size < 1e-9:
                continue
            w = (w / size).astype(np.float32)
            p = part @ w
            cut = 0.0 if 0.15 < (p > 0).mean() < 0.85 else float(np.median(p))
            crowd = float((np.abs(p - cut) < 0.05).mean())  # vectors that the plane nearly parts
            if best is None or crowd < best[0]:
                best = crowd, w, cut
        return None if best is None else best[1:]

    for _ in range(trees):
        roots.append(node())
        todo = [(roots[-1], np.arange(len(sample)))]
        while todo:
            at, rows = todo.pop()
            plane = split(rows) if len(rows) > most else None
            if plane is None:
                continue
            side = sample[rows] @ plane[0] > plane[1]
            if side.all() or not side.any():
                continue
            normal[at], offset[at] = plane
            left[at], right[at] = node(), node()
            todo += [(left[at], rows[~side]), (right[at], rows[side])]
    return Forest(np.array(normal, np.float32), np.array(offset, np.float32), np.array(left, np.int32), np.array(right, np.int32), np.array(roots, np.int32))


def _usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors and these, with unit length: of dim numbers, not null, no NaN or infinity, not all zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    at = np.flatnonzero(np.asarray(column.is_valid()) & (np.diff(offsets) == dim))
    if not len(at):
        return at, np.zeros((0, dim))
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    x = flat[offsets[at][:, None] + np.arange(dim)]
    with np.errstate(over="ignore", invalid="ignore"):
        norm = np.sqrt((x * x).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    return at[good], x[good] / norm[good, None]


def _binary(rows: np.ndarray) -> pa.Array:
    """An array of binary values, one per row of a matrix of bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _bytes(column: pa.Array, width: int = -1) -> np.ndarray:
    """The matrix of bytes of binary values, all of one width and none null."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, max(width, 0)), np.uint8)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(len(column), width)


def _pack(x: np.ndarray) -> pa.Array:
    """16-bit steps of each vector's largest entry, with the step in front: an error of a few hundred-thousandths of a cosine at most."""
    step = (np.abs(x).max(axis=1) / 32767).astype(np.float32)
    q = np.rint(x / step[:, None]).astype("<i2")
    return _binary(np.hstack([step.astype("<f4")[:, None].view(np.uint8), q.view(np.uint8).reshape(len(x), -1)]))


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = _bytes(column)
    return np.ascontiguousarray(raw[:, :4]).view("<f4")[:, 0].astype(np.float64), np.ascontiguousarray(raw[:, 4:]).view("<i2")


#: Columns of a block whose maximum is looked at first, and queries of a block.
_WIDTH, _QUERIES = 16, 256
#: More than the difference of two products of unit vectors can be off in single precision, for each of their numbers.
_ROUNDING = 1.5e-7
#: Times k groups of columns a query beyond which a block is multiplied again in double precision.
_CROWD = 4


def _candidates(s: np.ndarray, n: int, own: np.ndarray, k: int, off: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Row and column, by rows, of the k largest products of each row of s and of all that an error of off may have put
    behind them; None if these are very many.

    s has n columns, filled up to a multiple of the width, and is changed; own: the column of a row's own vector, or -1.
    """
    s[:, n:] = -np.inf
    has = np.flatnonzero(own >= 0)
    s[has, own[has]] = -np.inf
    groups = s.shape[1] // _WIDTH
    parts = s.reshape(len(s), _WIDTH, groups)
    if groups > k:
        # the k-th largest of the groups' maxima is no larger than the k-th largest product
        most = parts.max(1)
        least = np.maximum(np.partition(most, groups - k, axis=1)[:, groups - k] - off, -2)
        near = most >= least[:, None]
        if np.count_nonzero(near) > _CROWD * k * len(s):
            return None
        row, group = np.divmod(np.flatnonzero(near), groups)
    else:
        least = np.full(len(s), -2, np.float32)
        row, group = np.divmod(np.arange(len(s) * groups), max(1, groups))
    pick, within = np.divmod(np.flatnonzero(parts[row, :, group] >= least[row][:, None]), _WIDTH)
    return row[pick], group[pick] + groups * within


def _crowded(s: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and product of the k largest exact products of each row, of equal ones those of the first columns."""
    has = np.flatnonzero(own >= 0)
    s[has, own[has]] = -np.inf
    if s.shape[1] > k:
        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k, None]
        take = s >= least
        if np.count_nonzero(take) > 2 * k * len(s):
            equal = s == least
            take &= ~equal | (np.cumsum(equal, axis=1, dtype=np.int32) <= k - (s > least).sum(axis=1, keepdims=True))
    else:
        take = np.isfinite(s)
    row, column = np.nonzero(take)
    return row, column, s[row, column]


def _in_leaf(table: pa.Table, k: int) -> pa.Table:
    """The lists of the vectors and visitors of one leaf."""
    ids = table["id"].to_numpy()
    visitor = table["visitor"].to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((visitor, ids))  # at home before visiting, so that a vector that is sent twice counts once
    first = np.append(True, ids[order][1:] != ids[order][:-1])
    order = order[first]
    step, q = _unpack(table["vector"])
    ids, visitor, step, q = ids[order], visitor[order], step[order], q[order]
    x = (q * step[:, None]).astype(np.float32)
    data = np.flatnonzero(~visitor)
    out = [np.zeros((0, 12 * k), np.uint8)]
    if len(data):
        here, home = np.zeros((-(-len(data) // _WIDTH) * _WIDTH, x.shape[1]), np.float32), np.full(len(ids), -1)
        here[: len(data)] = x[data]
        home[data] = np.arange(len(data))
        products = np.empty((_QUERIES, len(here)), np.float32)
        for a in range(0, len(ids), _QUERIES):
            b = min(a + _QUERIES, len(ids))
            found = _candidates(np.matmul(x[a:b], here.T, out=products[: b - a]), len(data), home[a:b], k, _ROUNDING * x.shape[1])
            # exact for the packed vectors: whole numbers below 2**53, and the product of two steps doesn't depend on their order
            if found is None:
                row, column, score = _crowded((q[a:b].astype(np.float64) @ q[data].astype(np.float64).T) * (step[a:b, None] * step[data]), home[a:b], k)
            else:
                row, column = found
                i, j = a + row, data[column]
                score = np.einsum("ij,ij->i", q[i].astype(np.float64), q[j].astype(np.float64)) * (step[i] * step[j])
            at = data[column]
            by = np.lexsort((ids[at], -score, row))
            place = np.arange(len(row)) - np.searchsorted(row, row)
            by, row, place = by[place < k], row[place < k], place[place < k]
            near, away = np.zeros((b - a, k), "<i8"), np.full((b - a, k), np.inf, "<f4")
            near[row, place], away[row, place] = ids[at[by]], -score[by]
            out.append(_listed(near, away))
    else:
        ids = ids[:0]
    return pa.table({"id": pa.array(ids), "list": _binary(np.concatenate(out))})


def _listed(near: np.ndarray, away: np.ndarray) -> np.ndarray:
    """A row of bytes per list: all first bytes of the ids, all second ones and so on, which pack better, then those of the
    distances. Places that are left are infinitely far."""
    planes = lambda x: x.view(np.uint8).reshape(*x.shape, -1).transpose(0, 2, 1).reshape(len(x), -1)
    return np.hstack([planes(near), planes(away)])


def _merged(k: int):
    """id, near and away of the k nearest in all lists of an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["lists"]
            offsets = lists.offsets.to_numpy()
            raw = _bytes(lists.flatten())
            back = lambda x, kind: np.ascontiguousarray(x.reshape(len(x), -1, k).transpose(0, 2, 1)).view(kind).ravel()
            near, away = back(raw[:, : 8 * k], "<i8"), back(raw[:, 8 * k :], "<f4")
            row = np.repeat(np.repeat(np.arange(len(batch)), np.diff(offsets)), k)
            real = np.flatnonzero(np.isfinite(away))
            order = real[np.lexsort((near[real], away[real], row[real]))]
            row, near, away = row[order], near[order], away[order]
            # a neighbour that was met in several leaves has the same distance in all of them
            new = np.append(True, (row[1:] != row[:-1]) | (near[1:] != near[:-1])) if len(row) else np.zeros(0, bool)
            row, near, away = row[new], near[new], away[new]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            cut = pa.array(np.searchsorted(row[keep], np.arange(len(batch) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.ListArray.from_arrays(cut, pa.array(near[keep])), pa.ListArray.from_arrays(cut, pa.array(away[keep]))], ["id", "near", "away"])

    return run


def small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df


def _reranked(merged: DataFrame, source: DataFrame, k: int, dim: int) -> DataFrame:
    """id and c, the k best of each list (away, near): where packed cosines leave open who is among them, by the originals.

    Only candidates whose cosines lie about the k-th are compared again, and only in lists that have such a candidate
    beyond the k-th. A list that is shorter has nothing to decide.
    """
    last, after = F.element_at("c", k)["away"], F.element_at("c", k + 1)["away"]
    wide = merged.withColumn("last", F.when(F.size("c") > k, last)).withColumn("open", F.coalesce(F.when(F.size("c") > k, after - last <= _UNSURE), F.lit(False)))
    doubt = wide.filter("open").select("id", F.explode(F.filter("c", lambda x: F.abs(x["away"] - F.col("last")) <= _UNSURE)).alias("x")).select("id", "x.near")
    doubt = checkpointed(doubt)
    wanted = doubt.select(F.explode(F.array("id", "near")).alias("id")).distinct()
    few = doubt.count() <= _BROADCAST_ROWS // 2
    held = checkpointed(source.join(F.broadcast(wanted) if few else wanted, "id", "left_semi").groupBy("id").agg(F.first("vector").alias("vector")))

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (at, x), (also, y) = _usable(batch["x"], dim), _usable(batch["y"], dim)
            both, i, j = np.intersect1d(at, also, assume_unique=True, return_indices=True)
            rows = pa.array(both)
            yield pa.RecordBatch.from_arrays([batch["id"].take(rows), batch["near"].take(rows), pa.array(-(x[i] * y[j]).sum(1))], ["id", "near", "exact"])

    pairs = doubt.join(held.withColumnRenamed("vector", "x"), "id").join(held.select(F.col("id").alias("near"), F.col("vector").alias("y")), "near").select("id", "near", "x", "y")
    exact = pairs.mapInArrow(cosine, "id bigint, near bigint, exact double").groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.round("exact", 12).alias("exact"), "near"))).alias("decided"))
    joined = wide.join(exact, "id", "left")
    sure = F.filter("c", lambda x: x["away"] < F.col("last") - _UNSURE)
    chosen = F.slice(F.transform("decided", lambda e: e["near"]), F.lit(1), F.lit(k) - F.size(sure))
    kept = F.sort_array(F.concat(sure, F.filter("c", lambda x: F.array_contains(chosen, x["near"]))))
    return joined.select("id", F.when(F.col("decided").isNull(), F.slice("c", 1, k)).otherwise(kept).alias("c"))


def nearest(
    vectors: DataFrame, members: DataFrame, *, k: int = 10, key: str = "pmid", vector: str = "embedding", dim: int = 64,
    trees: int = 2, visits: int = 6, reach: float = 0.035, leaf: int = 12_000, sample: int = 50_000, seed: int = 7,
) -> DataFrame:
    """key, near, rank (from 1) and score (cosine): the k most similar of every key of members with a usable vector.

    Usable is a vector of dim numbers without null, NaN or infinity that isn't all zeros; its length doesn't count.
    Repeated rows count once; of different vectors under one key one is taken. Equal cosines are ordered by key. Null
    keys take no part. With k or fewer others all of them come out; an empty table gives no rows. The scores are those of
    the packed vectors, to four digits; ranks within the list go by them, while who is in the list goes by the originals.

    leaf is the largest number of vectors per block and sample the number of vectors, about, that the trees are fitted
    on: both bound what one task and the driver hold. visits is the largest number of further leaves of a vector, and
    reach how far beyond a plane, in the unit of the vectors' length, it looks for them: a vector near many planes visits
    many leaves, one in the middle of its leaves none. Recall rises with trees, visits, reach and leaf.
    """
    members = checkpointed(members.select(F.col(key).cast("bigint").alias("id")).filter(F.col("id").isNotNull()).distinct())
    members = small(members)
    source = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector")).filter(F.col("id").isNotNull() & F.col("vector").isNotNull())

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _usable(batch["vector"], dim)
            raw = (np.rint(x * 1e6) + 0.0).astype(np.int32)  # equal directions get equal bytes
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(at)), _binary(raw.view(np.uint8))], ["id", "raw"])

    hashed = source.mapInArrow(narrow, "id bigint, raw binary").select("id", F.struct(F.xxhash64("raw").alias("a"), F.xxhash64(F.lit(1), "raw").alias("b")).alias("h"))
    one = checkpointed(hashed.groupBy("id").agg(F.min("h").alias("h")))
    part = one.join(members, "id", "left_semi")
    # equal vectors: the least key stands for all of them
    same = checkpointed(part.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("n")).filter("n > 1").select("h", "rep"))
    equal = checkpointed(part.join(small(same), "h").select("rep", "id"))
    few = equal.count() <= _BROADCAST_ROWS
    hint = F.broadcast if few else (lambda df: df)
    apart = checkpointed(one.join(members, "id", "left_anti").select("id").unionByName(equal.filter("id <> rep").select("id")))
    size = one.count() - apart.count()
    used = source.join(small(apart), "id", "left_anti")

    # from all partitions alike, without a limit that would prefer the first ones
    picked = used.sample(min(1.0, sample / max(1, size)), seed).select("vector").toArrow()
    _, points = _usable(picked["vector"], dim)
    # a single leaf is the whole table: one tree and no visits compare everything with everything
    whole = size <= leaf
    trees, visits = (1, 0) if whole else (trees, visits)
    forest = fit_forest(points.astype(np.float32), 1.0 if whole else leaf / max(1, size), trees, seed) if len(points) else None
    if forest is None:
        blocks = np.ones(1, int)
    elif whole:
        # for the sake of several tasks: each compares all vectors with a part of them
        blocks = np.full(1, -(-size // 3000))
    else:
        # leaves that the sample can't split any further
        blocks = np.maximum(1, np.ceil(forest.shares(points.astype(np.float32)) * size / (2 * leaf))).astype(int)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _usable(batch["vector"], dim)
            if forest is None or not len(at):
                continue
            ids, raw = batch["id"].to_numpy()[at], _pack(x)
            home, visit = forest.leaves(x.astype(np.float32), visits, reach)
            part = np.abs(ids) % np.iinfo(np.int32).max
            for leaves, visitor in ((home, False), (visit, True)):
                for c in range(leaves.shape[1]):
                    real = np.flatnonzero(leaves[:, c] >= 0)
                    many = blocks[leaves[real, c]]
                    # into each block of the leaf, in one of them as a member and in the others as a visitor
                    row = np.repeat(real, many)
                    block = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    away = (part[row] % np.repeat(many, many) != block) | visitor
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaves[row, c], pa.int32()), pa.array(block, pa.int32()), pa.array(ids[row]), pa.array(away), raw.take(pa.array(row))],
                        ["leaf", "block", "id", "visitor", "vector"],
                    )

    placed = used.mapInArrow(assign, "leaf int, block int, id bigint, visitor boolean, vector binary")
    lists = placed.groupBy("leaf", "block").applyInArrow(lambda t: _in_leaf(t, k + _MARGIN), "id bigint, list binary")
    # a vector has a list per visit, a bounded number
    merged = lists.groupBy("id").agg(F.collect_list("list").alias("lists")).mapInArrow(_merged(k + _MARGIN), "id bigint, near array<bigint>, away array<float>")
    merged = checkpointed(merged)
    lists = _reranked(merged.select("id", F.arrays_zip("away", "near").alias("c")), used, k, dim)

    # back to all keys, in one pass over the lists: a neighbour stands for the k least keys with its vector, and a list
    # goes to every key that has the vector, after those keys themselves. Lists without equal vectors stay as they are
    firsts = equal.withColumn("n", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).filter(F.col("n") <= k + 1).groupBy("rep").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    firsts = checkpointed(firsts)
    standing = merged.select("id", F.explode("near").alias("near")).join(hint(firsts.withColumnRenamed("rep", "near")), "near")
    standing = standing.groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("near", F.slice("ids", 1, k)))).alias("stands"))
    each = lambda x: F.transform(F.coalesce(F.col("stands")[x["near"]], F.array(x["near"])), lambda n: F.struct(x["away"].alias("away"), n.alias("near")))
    others = lists.join(standing, "id", "left").select("id", F.when(F.col("stands").isNull(), F.col("c")).otherwise(F.slice(F.sort_array(F.flatten(F.transform("c", each))), 1, k)).alias("c"))
    spread = others.join(hint(equal.select(F.col("rep").alias("id"), F.col("id").alias("copy"))), "id", "left").join(hint(firsts.withColumnRenamed("rep", "id")), "id", "left")
    own = F.transform("ids", lambda i: F.struct(F.lit(-1.0).cast("float").alias("away"), i.alias("near")))
    every = spread.select(F.coalesce("copy", "id").alias("id"), "ids", "c", F.concat(own, "c").alias("all"))
    every = every.select("id", F.when(F.col("ids").isNull(), F.col("c")).otherwise(F.slice(F.sort_array(F.filter("all", lambda c: c["near"] != F.col("id"))), 1, k)).alias("c"))
    out = every.select("id", F.posexplode("c").alias("n", "c"))
    return out.select(F.col("id").alias(key), F.col("c.near").alias("near"), (F.col("n") + 1).alias("rank"), F.round(-F.col("c.away").cast("double"), 4).alias("score"))


def pairs(neighbours: DataFrame, *, key: str = "pmid") -> DataFrame:
    """key_a < key_b of all pairs of which one is in the other's list."""
    a, b = F.least(key, "near"), F.greatest(key, "near")
    return neighbours.select(a.alias(f"{key}_a"), b.alias(f"{key}_b")).distinct()
