"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue, exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, small_frame

#: Bytes of the sample that the trees are fitted to, and rows of it at most; the forest's own size follows from both.
SAMPLE_BYTES, SAMPLE_ROWS = 1 << 24, 20_000
TREES, LEAF = 10, 200
#: Recall that the number of leaves a query visits is chosen for, on rows of the sample held against the sample.
RECALL, CALIBRATION = 0.95, 256
#: A query's bound is the score that WIDE * k of all rows reach, by the sample, in single precision, which SLACK allows for.
WIDE, SLACK = 3, 1e-5
#: Rows of a leaf, and queries of one in expectation, that one group holds.
PART, QUERIES = 4096, 50_000
#: Rows and queries of a cell at most, and bytes of its rows' vectors; parts of the rows wanted, of as many rows each at least.
CELL, CELL_BYTES, PARTS, LEAST = 1 << 18, 1 << 26, 24, 4096
#: Queries looked at together, rows scored with them at once, visits that leave the search at once.
TOGETHER, TILE, VISITS = 128, 32_768, 1 << 18
#: Rows that a matrix product scores in the time of one row of a leaf; by so much the bound is loosened for queries that found too few.
CHEAP, LOOSER = 20, 8


@dataclass
class Forest:
    """Nodes of all trees: normals and offsets of the inner ones, children (inner: index; leaf: -1 - leaf), roots."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int
    lift: float  # length that every vector is lifted to by one more component, so that inner product orders distance


def fit(sample: np.ndarray, lift: float, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = 13) -> Forest:
    """Splits by the middle between two random points, at the median projection, until a leaf of the whole table has about `leaf` rows."""
    rng = np.random.default_rng(seed)
    x = lifted(sample, lift)
    least = max(2, round(leaf * len(x) / max(rows, 1)))
    normals: list = []
    offsets: list = []
    children: list = []
    leaves = 0

    def grow(own: np.ndarray) -> int:
        nonlocal leaves
        if len(own) > least:
            for _ in range(4):
                a, b = x[own[rng.choice(len(own), 2, replace=False)]]
                normal = a - b
                size = np.linalg.norm(normal)
                if size == 0:
                    continue
                p = x[own] @ (normal / size)
                middle = np.median(p)
                low = p < middle
                if 0 < low.sum() < len(own):
                    at = len(normals)
                    normals.append(normal / size), offsets.append(middle), children.append([0, 0])
                    children[at] = [grow(own[low]), grow(own[~low])]
                    return at
        leaves += 1
        return -leaves

    roots = [grow(np.arange(len(x))) for _ in range(trees)]
    return Forest(np.array(normals, np.float32).reshape(-1, x.shape[1]), np.array(offsets, np.float32), np.array(children, np.int64).reshape(-1, 2), roots, leaves, lift)


def lifted(x: np.ndarray, lift: float) -> np.ndarray:
    x = x.astype(np.float32) / np.float32(lift)
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))], axis=1)


def calibrated(forest: Forest, sample: np.ndarray, rows: int, k: int, recall: float) -> int:
    """Leaves to visit for the recall, by exact search in the sample: as many neighbours of a row there as it has k of all rows (one at least, farther than those sought).

    The place of each leaf in a query's queue is that of its priority, the largest margin on its path on the wrong side.
    """
    x = lifted(sample, forest.lift)
    own = np.arange(0, len(x), max(1, len(x) // CALIBRATION))[:CALIBRATION]
    near = max(1, min(round(k * len(x) / max(rows, 1)), len(x) - 1))
    if len(x) < 3 or not len(forest.normals):
        return forest.leaves
    places = np.full((len(forest.roots), len(x)), -1)
    for t, root in enumerate(forest.roots):
        places[t] = leaf_of(forest, x, root)
    q = x[own].copy()
    q[:, -1] = 0
    leaf = priorities(forest, q).T
    needed = []
    for i, row in enumerate(own):
        score = sample @ sample[row]
        score[row] = -np.inf
        best = np.argpartition(-score, near - 1)[:near]
        rank = np.empty(forest.leaves, np.int64)
        rank[np.argsort(leaf[i], kind="stable")] = np.arange(forest.leaves)
        needed.append(rank[places[:, best]].min(axis=0) + 1)
    return int(np.quantile(np.concatenate(needed), recall, method="higher"))


def priorities(forest: Forest, x: np.ndarray) -> np.ndarray:
    """The priority of each leaf (rows) in the queue of each query (columns): the largest margin on its path on the wrong side. x: lifted, the last component 0."""
    margins = forest.normals @ x.T - forest.offsets[:, None]
    far, leaf = np.zeros_like(margins), np.zeros((forest.leaves, len(x)), np.float32)
    nodes = np.array([n for n in forest.roots if n >= 0], np.int64)
    while len(nodes):
        m, above = margins[nodes], far[nodes]
        for child, wrong in zip(forest.children[nodes].T, (m, -m)):
            own, inner = np.maximum(above, wrong), child >= 0
            far[child[inner]], leaf[-1 - child[~inner]] = own[inner], own[~inner]
        nodes = forest.children[nodes].ravel()
        nodes = nodes[nodes >= 0]
    return leaf


def reach(leaf: np.ndarray, sizes: np.ndarray, trees: np.ndarray, probes: int, k: int) -> np.ndarray:
    """The priority up to which each query visits leaves: those of `probes` that have rows, and on until the ones of one tree hold k + 1 rows; all leaves of that priority count. trees: of each leaf."""
    some = np.flatnonzero(sizes)
    leaf, sizes, trees = leaf[some], sizes[some], trees[some]
    if not len(some):
        return np.zeros(leaf.shape[1], np.float32)
    place = min(probes, len(some)) - 1
    out = np.partition(leaf, place, axis=0)[place]
    held = np.add.reduceat(np.where(leaf <= out, sizes[:, None], 0), np.flatnonzero(np.r_[True, trees[1:] != trees[:-1]]), axis=0)  # leaves of a tree follow one another
    for i in np.flatnonzero(held.max(axis=0) <= k):
        order = np.argsort(leaf[:, i], kind="stable")
        full = [order[mine[at]] for t in np.unique(trees) for mine in [np.flatnonzero(trees[order] == t)] if (at := np.searchsorted(np.cumsum(sizes[order[mine]]), k, side="right")) < len(mine)]
        out[i] = max(out[i], leaf[full, i].min() if full else leaf[:, i].max())
    return out


def leaf_of(forest: Forest, x: np.ndarray, root: int) -> np.ndarray:
    at = np.full(len(x), root)
    while (inner := np.flatnonzero(at >= 0)).size:
        node = at[inner]
        right = np.einsum("ij,ij->i", x[inner], forest.normals[node]) >= forest.offsets[node]
        at[inner] = forest.children[node, right.astype(int)]
    return -1 - at


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def trees_of(forest: Forest) -> np.ndarray:
    """The tree of each leaf."""
    out = np.zeros(forest.leaves, np.int64)
    for t, root in enumerate(forest.roots):
        stack = [root]
        while stack:
            n = stack.pop()
            if n < 0:
                out[-1 - n] = t
            else:
                stack += forest.children[n].tolist()
    return out


def leaves_of(forest: Forest):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """vec_id, embedding -> vec_id, embedding, leaves: one of each tree."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = lifted(matrix(batch.column("embedding")), forest.lift)
            found = np.stack([leaf_of(forest, x, root) for root in forest.roots], axis=1).astype(np.int32)
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["vec_id", "embedding", "leaves"])

    return assign


def bounds(plain: np.ndarray, forest: Forest, sample: np.ndarray, place: int) -> np.ndarray:
    """The place-th score of each query, of length 1, in the sample, from 0; both are in parts of the lift. The query itself may be in the sample."""
    near = unit(plain).astype(np.float32) @ (sample / np.float32(forest.lift)).T
    place = min(place, len(sample) - 1)
    return -np.partition(-near, place, axis=1)[:, place]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def probes_of(forest: Forest, sizes: np.ndarray, probes: int, k: int, sample: np.ndarray, place: int):
    """Leaves in the order of the queue that all trees share, until `probes` are visited and the ones of one tree hold k + 1 rows."""
    tree_of = trees_of(forest).tolist()
    together = max(1, min(TOGETHER, VISITS // max(probes, 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        children = forest.children.tolist()
        for batch in (b.slice(at, together) for b in batches for at in range(0, b.num_rows, together)):
            plain = matrix(batch.column("embedding")).astype(np.float32)
            near = plain @ sample.T
            bound = -np.partition(-near, min(place, len(sample) - 1), axis=1)[:, min(place, len(sample) - 1)]  # the query itself may be in the sample
            x = lifted(plain, forest.lift)
            x[:, -1] = 0
            rows, leaves = [], []
            margins = x @ forest.normals.T - forest.offsets
            for i in range(len(x)):
                margin = margins[i].tolist()
                queue = [(-np.inf, root) for root in forest.roots]
                heapq.heapify(queue)
                visited, held = 0, [0] * len(forest.roots)
                while queue and (visited < probes or max(held) <= k):
                    far, node = heapq.heappop(queue)
                    while node >= 0:
                        m = margin[node]
                        low, high = children[node]
                        heapq.heappush(queue, (max(far, abs(m)), low if m >= 0 else high))
                        node = high if m >= 0 else low
                    leaf = -1 - node
                    if sizes[leaf]:
                        visited += 1
                        held[tree_of[leaf]] += int(sizes[leaf])
                        rows.append(i)
                        leaves.append(leaf)
            for at in range(0, len(rows), VISITS):
                some = rows[at : at + VISITS]
                own = batch.take(pa.array(some, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(leaves[at : at + VISITS], pa.int64()), own.column("vec_id"), own.column("embedding"), pa.array(bound.astype(np.float64)[some])], ["leaf", "query_id", "embedding", "low"])

    return search


def reaches_of(forest: Forest, sizes: np.ndarray, probes: int, k: int, sample: np.ndarray, place: int):
    """vec_id, embedding -> query_id, embedding, low, far: the bound (see `bounds`), and the priority up to which leaves are visited, not a row for each visit."""
    trees = trees_of(forest)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
            plain = matrix(batch.column("embedding"))
            x = lifted(plain, forest.lift)
            x[:, -1] = 0
            far = reach(priorities(forest, x), sizes, trees, probes, k).astype(np.float64)
            low = bounds(plain, forest, sample, place).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(low), pa.array(far)], ["query_id", "embedding", "low", "far"])

    return search


class Paths:
    """The inner nodes above each leaf, and on which side of them it lies."""

    def __init__(self, forest: Forest):
        self.forest = forest
        above: list = [()] * forest.leaves
        stack: list = [(root, ()) for root in forest.roots]
        while stack:
            n, path = stack.pop()
            if n < 0:
                above[-1 - n] = path
            else:
                stack += [(child, (*path, (n, sign))) for child, sign in zip(forest.children[n].tolist(), (1, -1))]
        self.node, self.sign = np.zeros((2, forest.leaves, max(1, max(map(len, above)))), np.int64)
        for leaf, path in enumerate(above):
            if path:
                self.node[leaf, : len(path)], self.sign[leaf, : len(path)] = zip(*path)

    def visited(self, x: np.ndarray, query: np.ndarray, leaves: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Whether a query's queue, up to the priority `far` of each query, gets to any of the leaves of each pair (columns: trees)."""
        out = np.zeros(len(query), bool)
        if not len(self.forest.normals):
            return ~out
        for own in leaves.T:
            left = np.flatnonzero(~out)
            pairs, at = np.unique(query[left] * self.forest.leaves + own[left], return_inverse=True)
            q, leaf = pairs // self.forest.leaves, pairs % self.forest.leaves
            good = np.zeros(len(pairs), bool)
            for i in range(0, len(pairs), 8192):
                some = slice(i, i + 8192)
                node = self.node[leaf[some]]
                margins = np.einsum("ndk,nk->nd", self.forest.normals[node], x[q[some]]) - self.forest.offsets[node]
                good[some] = (self.sign[leaf[some]] * margins).max(axis=1) <= far[q[some]] + SLACK
            out[left] = good[at]
        return out


def cell(forest: Forest, k: int):
    paths = Paths(forest)

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        """The k largest inner products of each query with the rows of the cell that are in leaves it visits, from its bound on.

        Products in single precision, with as much more as they may be off, say which rows may reach the bound; of those, the leaves are looked at.
        """
        ids, q = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        out: list = []
        if len(ids) and len(q):
            x, y = (matrix(t.column("embedding").combine_chunks()) for t in (rows, queries))
            leaves = matrix(rows.column("leaves").combine_chunks())
            low, far = queries.column("low").to_numpy(), queries.column("far").to_numpy()
            off = np.float32(2e-7 * (x.shape[1] + 8))
            scaled = (x / forest.lift).astype(np.float32)
            scaled = np.concatenate([scaled, off * np.linalg.norm(scaled, axis=1, keepdims=True)], axis=1)
            for at in range(0, len(q), TOGETHER):
                some = slice(at, at + TOGETHER)
                own, asked = unit(y[some]), y[some].astype(np.float64)
                size = np.linalg.norm(asked, axis=1) * forest.lift
                wide = np.concatenate([own, np.ones((len(own), 1))], axis=1).astype(np.float32)
                up = lifted(y[some], forest.lift)
                up[:, -1] = 0
                found: list = []
                for start in range(0, len(ids), TILE):
                    i, j = np.nonzero(wide @ scaled[start : start + TILE].T >= low[some, None].astype(np.float32))
                    j += start
                    i, j = (v[q[some][i] != ids[j]] for v in (i, j))
                    seen = paths.visited(up, i, leaves[j], far[some])
                    i, j = i[seen], j[seen]
                    score = np.empty(len(i))
                    for piece in (slice(p, p + TILE) for p in range(0, len(i), TILE)):
                        score[piece] = np.einsum("ij,ij->i", asked[i[piece]], x[j[piece]].astype(np.float64))  # each sum in the same order, so that equal vectors tie
                    good = score >= low[some][i] * size[i]
                    found.append((i[good], ids[j[good]], score[good]))
                i, vec, score = (np.concatenate(c) for c in zip(*found))
                order = np.lexsort((vec, -score, i))
                i, vec, score = i[order], vec[order], score[order]
                good = np.arange(len(i)) - np.searchsorted(i, i) < k
                out.append((q[some][i[good]], vec[good], score[good]))
        parts = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(parts, names=["query_id", "vec_id", "score"])

    return best


def rank(k: int):
    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        """The k largest inner products of each query with the rows of one part of a leaf, from the query's bound on."""
        rows = rows.sort_by("vec_id")
        ids, q = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        out: list = []
        if len(ids) and len(q):
            x = np.stack(rows.column("embedding").to_numpy()).astype(np.float64)
            y = np.stack(queries.column("embedding").to_numpy()).astype(np.float64)
            low = queries.column("low").to_numpy()
            for at in range(0, len(y), 256):
                own = q[at : at + 256]
                score = np.einsum("ik,jk->ij", y[at : at + 256], x)  # each sum in the same order, so that equal vectors tie
                score[own[:, None] == ids[None, :]] = -np.inf
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(score, top, axis=1)
                good = (value > -np.inf) & (value >= low[at : at + 256, None] - SLACK)
                out.append((np.repeat(own, good.sum(axis=1)), ids[top][good], value[good]))
        parts = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(parts, names=["query_id", "vec_id", "score"])

    return best


def usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    fine = F.forall(e, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & F.exists(e, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & e.isNotNull() & fine)


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, leaf: int = LEAF, probes: int | None = None, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each row whose vec_id is divisible by `every`.

    vectors: vec_id and embedding. The trees are fitted to a sample, drawn by a hash of vec_id, of at most SAMPLE_ROWS
    rows and SAMPLE_BYTES bytes, which bounds the forest that is broadcast; every row is put in one leaf of each tree. Vectors are lifted
    to one length by one more component, so that nearness in the trees is the inner product's. A query follows all trees by one
    queue of margins to `probes` leaves; by default as many as give the recall in the sample, searched exactly (`calibrated`): few where vectors
    lie in clusters, a share of all leaves where they lie evenly in all directions, as no tree can part those. Leaves are dealt out in parts of at most about PART rows, so that a
    leaf full of copies is many groups, and queries of a leaf in parts of about QUERIES; each part keeps the k nearest rows of a query, scored in double precision on the vectors themselves, from the score on that WIDE * k of all rows
    reach by the sample; a query that finds fewer than k so visits its leaves once more without that bound.

    Where a query visits so many leaves that a row for each visit is dearer than a product with all vectors, its leaves are told by the priority up to which
    its queue is followed, and parts of rows meet parts of queries in cells (`cell`); a row counts there if one of its leaves is visited, as before.

    Null, empty, zero and non-finite vectors, vectors of null components and rows of null vec_id take no part, nor do
    vectors whose length isn't the most frequent one. Rows of one vec_id are found once, by the best of their scores, and none by a query of that vec_id.
    Ties go to the smaller vec_id. Fewer than k candidates: all of them, as the queue is followed until one tree has given k + 1 rows; no rows: no rows. Other columns,
    whatever their names, are not looked at.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors), "ann-vectors")
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v)).alias("longest")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return rows.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "CAST(0 AS double) AS score").limit(0)
    rows = rows.where(F.size("embedding") == sizes.d)
    most = max(100, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * sizes.d)))
    drawn = F.xxhash64(F.lit(13), "vec_id")
    sample = rows.where(F.pmod(drawn, F.lit(1_000_003)) <= 1_000_003 * min(1.0, 1.1 * most / sizes.n)).orderBy(drawn, "vec_id").limit(most).select("embedding").toArrow()
    sample = matrix(sample.column(0).combine_chunks())
    forest = fit(sample, float(np.sqrt(sizes.longest)), sizes.n, trees, leaf)
    probes = probes or calibrated(forest, sample.astype(np.float32), sizes.n, k, recall)
    kind = vectors.schema["embedding"].dataType.simpleString()
    placed = materialize(rows.mapInArrow(leaves_of(forest), f"vec_id long, embedding {kind}, leaves array<int>"), "ann-leaves")
    held = np.zeros(forest.leaves, np.int64)
    for r in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():  # as many rows as the forest has leaves
        held[r.leaf] = r["count"]
    asked = rows.where(F.col("vec_id") % every == 0)
    n_asked = asked.count()
    flat = np.ascontiguousarray(sample, np.float32)
    place = max(1, round(WIDE * k * len(sample) / sizes.n))

    def in_leaves(queries: DataFrame, n: int, bounded: bool) -> DataFrame:
        large = np.flatnonzero(held > PART)  # a table of at most as many rows as the forest has leaves
        parts = small_frame(spark, {"leaf": large.tolist(), "parts": (-(-held[large] // PART)).tolist()}, pa.schema([("leaf", pa.int64()), ("parts", pa.int64())]))
        number = F.coalesce(F.col("parts"), F.lit(1))
        shares = max(1, -(-n * probes // (forest.leaves * QUERIES)))
        own = placed.select(F.explode(F.col("leaves").cast("array<bigint>")).alias("leaf"), "vec_id", "embedding").join(F.broadcast(parts), "leaf", "left")
        own = own.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), number).cast("int")).drop("parts").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        visits = queries.mapInArrow(probes_of(forest, held, probes, k, flat, place), f"leaf long, query_id long, embedding {kind}, low double")
        visits = visits if bounded else visits.withColumn("low", F.lit(float("-inf")))
        visits = visits.join(F.broadcast(parts), "leaf", "left").withColumn("part", F.explode(F.sequence(F.lit(0), (number - 1).cast("int")))).drop("parts")
        visits = visits.withColumn("share", F.pmod(F.xxhash64(F.lit(2), "query_id"), F.lit(shares)).cast("int"))
        group = ["leaf", "part", "share"]
        return visits.groupBy(*group).cogroup(own.groupBy(*group)).applyInArrow(rank(k), "query_id long, vec_id long, score double")

    n_parts = max(-(-sizes.n // max(1, min(CELL, CELL_BYTES // (4 * sizes.d)))), min(PARTS, -(-sizes.n // LEAST)))

    def in_cells(queries: DataFrame, n: int, place: int) -> DataFrame:
        n_shares = max(1, -(-n // CELL))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        own = placed.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(n_parts)).cast("int")).withColumn("share", every(n_shares))
        reaches = materialize(queries.mapInArrow(reaches_of(forest, held, probes, k, flat, place), f"query_id long, embedding {kind}, low double, far double"), "ann-reaches")
        reaches = reaches.withColumn("share", F.pmod(F.xxhash64(F.lit(2), "query_id"), F.lit(n_shares)).cast("int")).withColumn("part", every(n_parts))
        group = ["part", "share"]
        own, reaches = (t.repartition(n_parts * n_shares, *group) for t in (own, reaches))
        return reaches.groupBy(*group).cogroup(own.groupBy(*group)).applyInArrow(cell(forest, k), "query_id long, vec_id long, score double")

    def once(found: DataFrame) -> DataFrame:
        return materialize(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "ann-found")

    bounded = [lambda q, n: in_leaves(q, n, True)]
    if n_parts <= probes and probes * CHEAP * trees >= forest.leaves:
        bounded = [lambda q, n: in_cells(q, n, place), lambda q, n: in_cells(q, n, LOOSER * place)][: 1 + (LOOSER * place < len(sample))]
    best, short, n_short = None, asked, n_asked
    for search in [*bounded, lambda q, n: in_leaves(q, n, False)]:  # queries whose leaves hold fewer than k rows from the bound on: once more with another, or none
        found = once(search(short, n_short))
        best = found if best is None else best.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(found)
        enough = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
        short = materialize(short.join(enough, "vec_id", "left_anti"), "ann-short")
        if not (n_short := short.count()):
            break
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
