"""SimHash near-duplicates: fingerprints, and a binary trie self-join within a Hamming error budget."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, fresh, held_by, materialize, maybe_in, row_tag
from .graph import components
from .spans import Held, grouped, links
from .wording import BLANKS, POWERS, mixed, parts, prints, sequences, unseen, words_of

SEED = 42
#: Differing bits that link two fingerprints. Four disjoint bit blocks and three errors leave one block without error.
BUDGET, BLOCKS = 3, 4
#: A group of one block value with more fingerprints than this is dealt out again by the blocks of its other bits.
LARGE_GROUP = 32_768
#: Node pairs with at most this many key pairs are compared at once.
LEAF = 64
PIECE = 1 << 20


def ascii_words(text: str | None) -> list[bytes]:
    """Words of the text with A to Z lower-cased; bytes.split knows the same six blanks as the word pattern."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], k: int) -> list[bytes]:
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def fingerprint_of(features: list[bytes], seed: int = SEED) -> int:
    """A bit is 1 if over half of the features' hashes have it; 0 without features."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(features), 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(x, seed) for x in features[at : at + (1 << 16)]], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(features), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(k: int) -> Callable[[Column], Column]:
    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint_of(shingles(ascii_words(t), k)) for t in texts.to_pylist()], pa.int64())

    return fingerprint


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i and j; each label is the least index of its set."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_join(keys: np.ndarray, depth: int, budget: int, matched: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Self-join of sorted distinct 64-bit keys: a node of the binary trie is a range of keys with a common prefix.

    Pairs of nodes of one depth are followed down together. A step from a pair to its children's pairs adds an error
    where the branches differ; pairs over the budget are dropped. It begins with each node of the given depth paired
    with itself. Pairs of small nodes are compared key by key; `matched` gets the indices, i < j, piece by piece.
    """
    if len(keys) < 2:
        return
    starts = np.flatnonzero(np.r_[True, (keys[1:] >> np.uint64(64 - depth)) != (keys[:-1] >> np.uint64(64 - depth))])
    ends = np.r_[starts[1:], len(keys)]
    many = ends - starts > 1
    level = (starts[many], ends[many], starts[many], ends[many], np.zeros(many.sum(), np.int8))
    stack = [(depth, *level)]
    while stack:
        d, a0, a1, b0, b1, err = stack.pop()
        if len(a0) > PIECE:  # one part at a time, deepest first, so that the frontier stays small
            stack += [(d, *(x[at : at + PIECE] for x in (a0, a1, b0, b1, err))) for at in range(0, len(a0), PIECE)]
            continue
        small = ((a1 - a0) * (b1 - b0) <= LEAF) | (d == 64)
        compare(keys, *(x[small] for x in (a0, a1, b0, b1)), budget, matched)
        a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        middle = lambda lo, hi: np.clip(np.searchsorted(keys, (keys[lo] & ~np.uint64((1 << (64 - d)) - 1)) | np.uint64(1 << (63 - d))), lo, hi)  # noqa: B023, E731
        am, bm, same = middle(a0, a1), middle(b0, b1), a0 == b0
        kids = [(a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1)]
        kids.append(tuple(x[~same] for x in (am, a1, b0, bm, err + 1)))
        a0, a1, b0, b1, err = (np.concatenate(x) for x in zip(*kids))
        alive = (err <= budget) & (a1 > a0) & (b1 > b0) & ~((a0 == b0) & (a1 - a0 < 2))
        stack.append((d + 1, *(x[alive] for x in (a0, a1, b0, b1, err))))


def compare(keys: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, budget: int, matched: Callable) -> None:
    sizes = (a1 - a0) * (b1 - b0)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(PIECE, sizes.sum() + PIECE, PIECE), side="left") + 1
    for lo, hi in zip(np.r_[0, cuts[:-1]], cuts):
        n = sizes[lo:hi]
        if not n.sum():
            continue
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(b1[lo:hi] - b0[lo:hi], n)
        i, j = np.repeat(a0[lo:hi], n) + within // width, np.repeat(b0[lo:hi], n) + within % width
        near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        if near.any():
            matched(i[near], j[near])


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole groups, sorted by group: an edge (a, b) from each node to the least of its set under links within the budget."""
    for node, label in sets_of(batches):
        b = node[label]
        yield pa.RecordBatch.from_arrays([pa.array(node[node != b], pa.int64()), pa.array(b[node != b], pa.int64())], ["a", "b"])


def clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole groups, sorted by group: key, node of each set of several nodes under links within the budget; the key is a hash of the set."""
    for node, label in sets_of(batches):
        order = np.lexsort((node, label))
        node, label = node[order], label[order]
        new = np.r_[True, (label[1:] != label[:-1]) | (node[1:] != node[:-1])]
        node, label = node[new], label[new]
        first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
        size = np.diff(np.r_[first, len(node)])
        name = mixed(np.add.reduceat(mixed(node.view(np.uint64)), first) + size.astype(np.uint64))
        kept = np.repeat(size > 1, size)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name, size)[kept].view(np.int64)), pa.array(node[kept])], ["key", "node"])


def linked(prints: DataFrame, large_group: int = LARGE_GROUP) -> DataFrame:
    """Edges (a, b) that span the links among rows (node long, fp long) of prints, distinct nodes."""
    return dealt(prints, large_group).mapInArrow(stars, "a long, b long")


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes of some whole groups of one path and depth in the order of their keys, and for each the place of the least of its set. Equal keys are in one set."""
    for _, path, key, fixed, node in grouped(batches, PIECE):
        key = key.view(np.uint64)
        for lane, depth in np.unique(np.stack([path, fixed], axis=1), axis=0):
            own = np.flatnonzero((path == lane) & (fixed == depth))
            own = own[np.lexsort((node[own], key[own]))]
            k, first = np.unique(key[own], return_index=True)
            label = np.repeat(first, np.diff(np.r_[first, len(own)]))
            trie_join(k, int(depth), BUDGET, lambda i, j: unite(label, first[i], first[j]))  # noqa: B023
            yield node[own], label[label]


def dealt(prints: DataFrame, large_group: int) -> DataFrame:
    """Rows (group, path, key, fixed, node) of prints in the groups that a trie join takes whole, dealt out over the cluster and sorted by group.

    With a column `table`, each node has a fingerprint for each table, and those of one table are linked.

    Each fingerprint enters one trie for each of four bit blocks, rotated so that this block comes first: a link has at
    least one block without error, whose node pairs are those of the top levels with nothing spent. Groups of one block
    value are dealt out over the cluster. A group over large_group is dealt out again by the four blocks of the bits that
    are left, up to two times, after which 37 bits are shared.
    """
    rotated = lambda i: F.shiftleft("fp", 16 * i).bitwiseOR(F.shiftrightunsigned("fp", 64 - 16 * i)) if i else F.col("fp")
    lanes = F.explode(F.array(*[F.struct(F.lit(i).alias("path"), rotated(i).alias("key")) for i in range(BLOCKS)]))
    lane = F.col("lane.path") + (F.col("table") * 1024 if "table" in prints.columns else 0)
    rows = prints.select(*prints.columns, lanes.alias("lane")).select("node", lane.alias("path"), "lane.key", F.lit(16).alias("fixed"))
    done = None
    for fixed in (16, 28):
        group = F.shiftrightunsigned("key", 64 - fixed)
        large = rows.groupBy("path", group.alias("group")).count().where(F.col("count") > large_group).select("path", "group")
        if large.isEmpty():
            break
        marked = rows.withColumn("group", group).join(large.withColumn("large", F.lit(True)), ["path", "group"], "left")
        marked = materialize(marked, "simhash-large")
        small = marked.where("large is null").select("node", "path", "key", "fixed")
        done = small if done is None else done.unionByName(small)
        left = 64 - fixed
        width, mask = left // BLOCKS, (1 << left) - 1
        low, high = F.col("key").bitwiseAND(F.lit(mask)), F.col("key").bitwiseAND(F.lit(~mask))
        turned = lambda j: high.bitwiseOR(F.shiftleft(low, j * width).bitwiseOR(F.shiftrightunsigned(low, left - j * width)).bitwiseAND(F.lit(mask)) if j else low)  # noqa: B023, E731
        lanes = F.explode(F.array(*[F.struct((F.col("path") * BLOCKS + 4 + j).alias("path"), turned(j).alias("key")) for j in range(BLOCKS)]))
        rows = marked.where("large").select("node", lanes.alias("lane")).select("node", "lane.path", "lane.key", F.lit(fixed + width).alias("fixed"))
    if done is not None:
        rows = done.unionByName(rows)
    rows = rows.select(F.xxhash64("path", "fixed", F.expr("shiftrightunsigned(key, 64 - fixed)")).alias("group"), "path", "key", "fixed", "node")
    return rows.repartition("group").sortWithinPartitions("group")


def cluster(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row of docs (doc_id, text).

    fp: SimHash of the k-word shingles; null, empty and blank texts have fingerprint 0 and are linked like any other.
    Equal fingerprints are one node before anything is joined, so that copies cost nothing more. component_id is the
    least doc_id that links reach, null doc_ids aside. Repeated rows each give a row. No rows: no rows. Other columns
    are not looked at.
    """
    prints = materialize(docs.select("doc_id", fingerprints(k)("text").alias("fp")), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = materialize(nodes, "simhash-nodes")
    edges = linked(nodes.select(F.col("fp").alias("node"), "fp"))
    joined = nodes.join(components(edges, "simhash-edges"), nodes.fp == F.col("node"), "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("component"))
    joined = materialize(joined, "simhash-components")
    # alone: the row's own doc_id, so that only classes of two and more are joined to the documents
    classes = joined.where((F.col("component") != F.col("fp")) | (F.col("n") > 1)).select("component").distinct()
    least = joined.join(classes, "component", "left_semi").groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


#: Independent fingerprints of a text in `near_copies`, and the similarity of shingle sets that links.
TABLES, SIMILAR = 6, 0.8
#: Bins of the sketch that spares the comparison of sets far from SIMILAR, and the least estimate, four standard errors below it.
BINS, LEAST = 128, 0.66


def texts_of(batch: pa.RecordBatch, column: int) -> Iterator[tuple]:
    """Of parts of a batch: the part, hashes of its words (A to Z lower-cased, parted by blanks), and of each text the first word and their number."""
    for part, texts in parts(batch, column, pc.ascii_lower):
        hashes, _, line, text, _ = words_of(texts, BLANKS)
        size = np.bincount(text[line], minlength=part.num_rows)
        yield part, hashes, np.cumsum(size) - size, size


def names_of(hashes: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences; that of no words is 0."""
    return np.where(size > 0, mixed(sequences(hashes, at, at + size, POWERS[1]) + size.astype(np.uint64)), np.uint64(0))


def distinct_by(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each of n owners in rising order, and their numbers."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])][: len(owner)]
    return values[new], np.bincount(owner[new], minlength=n)


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, tag, text -> doc_id, tag, node (hash of the words), prints: TABLES fingerprints of the distinct words."""
    for batch in batches:
        for part, hashes, at, size in texts_of(batch, 2):
            node = names_of(hashes, at, size)
            words, number = distinct_by(np.repeat(np.arange(len(size)), size), hashes, len(size))
            some = number > 0
            marks = np.zeros((len(size), TABLES), np.uint64)
            for t in range(TABLES):
                words = mixed(words + np.uint64(t + 1))
                if some.any():
                    marks[some, t] = prints(words, number[some])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(size) * TABLES + 1, TABLES, dtype=np.int32)), pa.array(marks.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(node.view(np.int64)), lists], ["doc_id", "tag", "node", "prints"])


def shingling(bits: np.ndarray, k: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> node, value: the distinct k-word shingles, 32 bits of hash each, of texts that may be among the nodes of the bitmap; short texts are one shingle."""
        seen: set = set()
        for batch in batches:
            for _, hashes, at, size in texts_of(batch, 0):
                node = names_of(hashes, at, size)
                own = np.flatnonzero(held_by(bits, node))
                own = own[unseen(seen, node[own])]
                number = np.where(size[own] > 0, np.maximum(size[own] - k + 1, 1), 0)
                owner = np.repeat(np.arange(len(own)), number)
                start = at[own][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                end = np.minimum(start + k, (at + size)[own][owner])
                values, number = distinct_by(owner, mixed(sequences(hashes, start, end, POWERS[1])).astype(np.uint32), len(own))
                ends = np.cumsum(number)
                yield pa.RecordBatch.from_arrays([pa.array(node[own].view(np.int64)), pa.array([values[e - n : e].tobytes() for e, n in zip(ends, number)], pa.binary())], ["node", "value"])

    return shingle


class Shingled(Held):
    """Texts of some sets as their shingles."""

    def __init__(self, values: list[bytes]) -> None:
        super().__init__(values)
        self.sets_ = [np.frombuffer(v, np.uint32) for v in values]
        self.size = np.array([len(v) for v in self.sets_], np.int64)
        self.sketch = np.zeros((len(values), BINS), np.uint16)
        for row, v in zip(self.sketch, self.sets_):  # the least value of a bin comes last, as shingles rise
            row[v[::-1] % BINS] = (v[::-1] // BINS & 0xFFFE | 1).astype(np.uint16)

    def close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        good = np.flatnonzero(np.minimum(self.size[x], self.size[y]) >= SIMILAR * np.maximum(self.size[x], self.size[y]) - 1e-9)
        kept = []
        for at in range(0, len(good), 1 << 14):
            own = good[at : at + (1 << 14)]
            p, q = self.sketch[x[own]], self.sketch[y[own]]
            kept.append(own[((p == q) & (p != 0)).sum(axis=1) >= LEAST * ((p != 0) | (q != 0)).sum(axis=1)])
        return np.concatenate(kept) if kept else good

    def similar(self, i: int, j: int) -> bool:
        p, q = self.sets_[i], self.sets_[j]
        both = len(np.intersect1d(p, q, assume_unique=True))
        return both >= SIMILAR * (len(p) + len(q) - both) - 1e-9


def near_copies(docs: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """doc_id, tag of the documents (doc_id, tag, text) that are copies or near copies of one that comes before them, and of those with several rows.

    Texts of the same words, A to Z alike, are one node. Fingerprints of their distinct words, in each of TABLES independent hashes, are joined by the
    trie self-join within 3 bits; nodes of one set of such links are compared by their k-word shingles, and linked if the sets have a similarity (Jaccard)
    of 0.8 or more, exactly but for 32-bit hashes. Recall is measured (README). Of each connected group the least doc_id stays, ties to the least tag.

    Texts without words, null ones too, are copies of each other. Rows that agree in doc_id and text (tag is a hash of both) are one document; others
    of one doc_id are others. A null doc_id is greater than any other. Other columns are not looked at. No rows: no rows.
    """
    found = materialize(docs.select("doc_id", "tag", "text").mapInArrow(describe, "doc_id long, tag long, node long, prints array<long>"), "near-prints")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tag")
    nodes = materialize(found.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("prints").alias("prints")), "near-nodes")
    entries = nodes.where("node <> 0").select("node", F.posexplode("prints").alias("table", "fp"))
    shared = materialize(dealt(entries, LARGE_GROUP).mapInArrow(clusters, "key long, node long").distinct(), "near-sets")
    bits = bitmap(shared.select("node").distinct(), "node")
    values = docs.select("text").mapInArrow(shingling(bits, k), "node long, value binary").groupBy("node").agg(F.first("value").alias("value"))
    groups = materialize(components(links(shared, values, Shingled), "near-edges").join(nodes.select("node", "first"), "node"), "near-groups")
    kept = groups.groupBy("component").agg(F.min_by("node", "first").alias("node")).select("node", F.lit(True).alias("kept"))
    lost = groups.join(kept, "node", "left").where("kept IS NULL").select("node", F.lit(True).alias("lost"))
    several = nodes.select("node", "first", "last").join(lost, "node", "left").where("lost OR first <> last").select("node", "first", F.coalesce("lost", F.lit(False)).alias("lost"))
    gone = found.select("doc_id", "tag", "node").join(several, "node").where("lost OR NOT (tag = first.tag AND doc_id <=> first.doc_id)").select("doc_id", "tag").distinct()
    return gone, found.groupBy("doc_id", "tag").count().where("count > 1").select("doc_id", "tag")


def without_near_copies(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row of docs for each group of near copies; see `near_copies`. Of rows that agree in doc_id and text, one stays. Columns of any name stay as they are."""
    tag, key, mark = fresh(docs, "tag", "key", "mark")
    long_id = F.col("doc_id").cast("long")
    marked = docs.withColumn(tag, row_tag(long_id, F.col("text")))
    gone, several = near_copies(marked.select(long_id.alias("doc_id"), F.col(tag).alias("tag"), "text"), k)
    gone, several = materialize(gone, "near-gone"), materialize(several, "near-several")
    touched = maybe_in(bitmap(gone.select("tag").unionByName(several.select("tag")), "tag"))(F.col(tag))
    leaving = gone.select(F.col("doc_id").alias(key), F.col("tag").alias(mark))
    rest = marked.where(touched).join(leaving, (F.col(tag) == F.col(mark)) & long_id.eqNullSafe(F.col(key)), "left_anti").dropDuplicates(["doc_id", tag])
    return marked.where(~touched).unionByName(rest).select(docs.columns)
