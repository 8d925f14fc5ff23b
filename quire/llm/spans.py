"""Links between nodes that share a key, verified where the nodes meet: what leaves a task spans its groups, however many pairs they have."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..store import materialize

#: Pairs that are looked at once, rows of groups that are held with their values, and nodes of a group from which it is dealt out over several tasks.
PIECE, HELD, HOT = 1 << 20, 1 << 17, 20_000
#: Rows of keys with nodes in common that one task gets, about.
NEAR = 4096


def grouped(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups of one key (the first column) from sorted rows, some `piece` rows of groups at once."""
    held: list = []
    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
        if n >= piece:
            rows = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield [c[:cut] for c in rows]
            held, n = [[c[cut:] for c in rows]], n - cut
    if n:
        yield [np.concatenate(c) for c in zip(*held)]


class Held:
    """Nodes of some groups with their values, and the sets that links make of them. Kinds say what is close and what is similar."""

    def __init__(self, values: list[bytes]) -> None:
        self.values, self.apart = values, set()
        self.up = list(range(len(values)))

    def close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Places of the pairs of nodes that can be similar: a quick test that loses (hardly) any."""
        raise NotImplementedError

    def similar(self, i: int, j: int) -> bool:
        raise NotImplementedError

    def top(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def sets(self) -> np.ndarray:
        return np.array([self.top(i) for i in range(len(self.up))], np.int64)

    def link(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int]]:
        """Those of the pairs, each once, that are similar and not joined by others."""
        n = len(self.values)
        good = self.close(x, y)
        x, y = x[good], y[good]
        pairs = np.unique(np.minimum(x, y) * n + np.maximum(x, y))
        if len(self.apart) > PIECE:
            self.apart.clear()
        for i, j in zip((pairs // n).tolist(), (pairs % n).tolist()):
            a, b = self.top(i), self.top(j)
            if a == b or (i, j) in self.apart:
                continue
            if self.similar(i, j):
                self.up[max(a, b)] = min(a, b)
                yield i, j
            else:
                self.apart.add((i, j))


def spanning(kind: Callable[[list[bytes]], Held]):
    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """key, node, value sorted by key and node -> a, b: links that span the sets of similar nodes of each key.

        Each node is compared with the first of its group and with the one before it; then, for all groups held, the nodes of
        different sets with each other, so that a group of copies is a few comparisons and no link between sets is lost.
        """
        for key, node, value in grouped(batches, HELD):
            names, first, own = np.unique(node, return_index=True, return_inverse=True)
            held = kind(value[first].tolist())
            here, head = np.arange(len(key)), np.searchsorted(key, key)
            before = np.maximum(here - 1, head)
            found = [*held.link(own[head], own), *held.link(own[before], own)]
            label = held.sets()
            order = np.lexsort((label[own], key))
            key, own = key[order], own[order]
            run = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (label[own[1:]] != label[own[:-1]])])
            run_end = np.repeat(np.r_[run[1:], len(key)], np.diff(np.r_[run, len(key)]))
            count = np.searchsorted(key, key, side="right") - run_end
            some = np.flatnonzero(count)
            total = np.cumsum(count[some])
            at = 0
            while at < len(some):
                stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PIECE, side="right")), at + 1)
                i, c = some[at:stop], count[some[at:stop]]
                x = np.repeat(i, c)
                y = own[run_end[x] + np.arange(len(x)) - np.repeat(np.cumsum(c) - c, c)]
                x = own[x]
                apart = label[x] != label[y]
                new = list(held.link(x[apart], y[apart]))
                if new:
                    found += new
                    label = held.sets()
                at = stop
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(names[a], pa.int64()), pa.array(names[b], pa.int64())], ["a", "b"])

    return span


def links(shared: DataFrame, values: DataFrame, kind: Callable[[list[bytes]], Held], hot: int = HOT) -> DataFrame:
    """Edges (a, b) that span the groups that similarity makes of nodes. shared: key, node (each pair once); values: node, value.

    A key of more than `hot` nodes is dealt into cells, one for each pair of its parts, so that every pair of nodes meets in one of them and no task
    holds more than about 2 * hot nodes of a key. Keys with nodes in common are dealt out together (`labelled`).
    """
    large = shared.groupBy("key").count().where(F.col("count") > hot).select("key", F.ceil(F.col("count") / hot).cast("int").alias("n"))
    part = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda t: F.xxhash64("key", F.least(t, F.col("part")), F.greatest(t, F.col("part"))))
    dealt = shared.join(large, "key", "left").withColumn("part", part)
    dealt = dealt.select("node", F.explode(F.when(F.col("n").isNull(), F.array("key")).otherwise(cells)).alias("key"))
    rows = labelled(dealt).join(values, "node").select("key", "node", "value").repartition(F.shiftright("key", 32)).sortWithinPartitions("key", "node")
    return rows.mapInArrow(spanning(kind), "a long, b long")


def labelled(dealt: DataFrame, near: int = NEAR) -> DataFrame:
    """key, node with other keys: those that have nodes in common mostly agree in the upper 32 bits, up to about `near` rows, so that a pair that shares many keys
    meets in one task and is verified once. Rows of one key keep one key; should two keys get the same, more pairs are compared and none is lost."""
    least = lambda c, by: F.min(c).over(Window.partitionBy(by))
    found = dealt.withColumn("label", least("node", "key")).withColumn("label", least("label", "node")).withColumn("label", least("label", "key"))
    found = materialize(found.select("key", "node", "label"), "spans-labels")
    large = found.groupBy("label").count().where(F.col("count") > near).select("label", F.ceil(F.col("count") / near).cast("int").alias("n"))
    part = F.when(F.col("n").isNull(), F.col("label")).otherwise(F.xxhash64("label", F.pmod(F.xxhash64("key"), F.col("n"))))
    key = part.bitwiseAND(F.lit(-1 << 32)).bitwiseOR(F.xxhash64("key").bitwiseAND(F.lit((1 << 32) - 1)))
    return found.join(large, "label", "left").select(key.alias("key"), "node")
