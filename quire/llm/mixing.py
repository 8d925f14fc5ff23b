"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, small_frame

#: Shards beyond one for each source, which all are rows on the driver, and sources up to which their table is broadcast.
MAX_SHARDS, MOST_BROADCAST = 32_768, 10_000


#: Columns that the mix gives for each document.
OUTPUT = ("doc_id", "source", "size", "source_size", "target", "taken", "n_blocks")


def capped_targets(sizes: list[int], weights: list[float], cap: float) -> list[float]:
    """Shares the sum of sizes by weight; a target stops at cap times its size and the excess is shared again among the rest."""
    total, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(t for i, t in enumerate(targets) if i not in open_)
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * unit > cap * sizes[i]}
        for i in over or open_:
            targets[i] = cap * sizes[i] if over else weights[i] * unit
        if not over:
            break
        open_ -= over
    return targets


def sainte_lague(values: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients value / (2 k + 1), none beyond `most`; ties go to the first.

    Rounding each value over a common divisor is the allocation for some number of seats, so that only the difference
    is dealt out (or taken back) by single quotients.
    """
    values, most = np.asarray(values, dtype=np.float64), np.asarray(most, dtype=np.int64)
    total = values.sum()
    if total <= 0 or seats <= 0:
        return np.zeros(len(values), dtype=np.int64)
    got = np.minimum(np.floor(values * (seats / total) + 0.5).astype(np.int64), most)
    missing = int(min(seats, most.sum()) - got.sum())
    if missing > 0:
        heap = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(values, got, most)) if g < m and v > 0]
        heapq.heapify(heap)
        while missing and heap:
            _, i = heapq.heappop(heap)
            got[i] += 1
            missing -= 1
            if got[i] < most[i]:
                heapq.heappush(heap, (-values[i] / (2 * got[i] + 1), i))
    elif missing < 0:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(values, got)) if g > 0]
        heapq.heapify(heap)
        while missing:
            _, i = heapq.heappop(heap)
            got[-i] -= 1
            missing += 1
            if got[-i] > 0:
                heapq.heappush(heap, (values[-i] / (2 * got[-i] - 1), i))
    return got


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, seed: int = 7, block_words: int = 64, shard_words: int = 131_072, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and n_blocks, and the columns named by carry, of every row of docs
    (doc_id, text, source). A carried column whose name one of the others has gets underscores at its end.

    Sources, ordered by code point with null last, take the weights in turn and share all words; a target stops at `cap`
    times the source's size. Each source is dealt into shards by a hash of doc_id, so that no source is ever one task. A
    shard is cut, in a seeded order of its documents, into blocks of equal numbers of words; Sainte-Lague gives blocks
    to sources by their targets and then, within a source, to shards by their words. A shard takes each of its blocks
    quota // blocks times and the rest once, picked by a seeded permutation of the block numbers. Blocks have block_words words; a source whose
    words or target are fewer than 256 such blocks has smaller ones, a power of two, and shares seats with the sources of equal blocks. A source whose target is at the cap gets `cap` times all its blocks. The driver holds one
    row for each source and for each shard (at most MAX_SHARDS and the sources), whatever the number of documents.

    Null text or text without words: size and taken 0. Null source: a source of its own. Repeated rows each count; rows of one doc_id are ordered by size
    and by a hash of their text. No rows: no rows. Other columns of docs are not looked at.
    """
    spark = docs.sparkSession
    kept = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(0)  # one column, whose fields can't clash
    sized = materialize(docs.select("doc_id", "source", kept.alias("kept"), F.xxhash64("text").alias("tag"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    words = [r.words for r in found]
    targets = capped_targets(words, [weights[i % len(weights)] for i in range(len(words))], cap)
    total = sum(words)
    step = max(shard_words, math.ceil(total / MAX_SHARDS))
    fine = [int(min(w, t)) // 256 for w, t in zip(words, targets)]
    block = {r.source: min(block_words, 1 << max(0, f.bit_length() - 1)) for r, f in zip(found, fine)}
    names = [r.source for r in found]
    per_source = small_frame(
        spark,
        {"known": names, "source_size": words, "target": targets, "n_shards": [max(1, math.ceil(w / step)) for w in words]},
        pa.schema([("known", pa.string()), ("source_size", pa.int64()), ("target", pa.float64()), ("n_shards", pa.int64())]),
    )
    dealt = (
        sized.join(F.broadcast(per_source) if len(names) <= MOST_BROADCAST else per_source, sized.source.eqNullSafe(per_source.known))
        .drop("known")
        .withColumn("draw", F.xxhash64(F.lit(seed), F.lit("order"), "doc_id"))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "doc_id"), F.col("n_shards")))
    )
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()
    by_source: dict = {}
    for r in sorted(shards, key=lambda r: r.shard):
        by_source.setdefault(r.source, []).append((r.shard, r.words))
    blocks = {s: np.array([max(1, round(w / block[s])) if w else 0 for _, w in rows], dtype=np.int64) for s, rows in by_source.items()}
    most = np.array([cap * blocks[s].sum() if s in blocks else 0 for s in names], dtype=np.int64)
    quotas = most.copy()  # of sources whose target is at the cap
    for size in sorted(set(block.values())):
        own = [i for i, s in enumerate(names) if block[s] == size and targets[i] < cap * words[i]]
        shares = np.array([targets[i] for i in own])
        quotas[own] = sainte_lague(shares, round(shares.sum() / size), most[own])
    columns: dict = {"s": [], "k": [], "n_blocks": [], "quota": [], "shard_size": []}
    for name, quota in zip(names, quotas):
        rows = by_source.get(name, [])
        got = sainte_lague(np.array([w for _, w in rows]), int(quota), cap * blocks[name]) if rows else []
        for (shard, w), n, q in zip(rows, blocks.get(name, []), got):
            for key, value in zip(columns, (name, shard, int(n), int(q), w)):
                columns[key].append(value)
    plan = small_frame(spark, columns, pa.schema([("s", pa.string()), ("k", pa.int64()), ("n_blocks", pa.int64()), ("quota", pa.int64()), ("shard_size", pa.int64())]))
    ends = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        dealt.withColumn("end", F.sum("size").over(ends))
        .join(F.broadcast(plan) if len(columns["s"]) <= MAX_SHARDS + MOST_BROADCAST else plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("k")))
        .withColumn("start", F.col("end") - F.col("size"))
    )
    n, size = F.greatest("n_blocks", F.lit(1)), F.greatest("shard_size", F.lit(1))  # shards without words have neither
    first, last = F.expr("(start * n_blocks) div greatest(shard_size, 1)"), F.expr("((end - 1) * n_blocks) div greatest(shard_size, 1)")
    begins = lambda k: F.floor((k * size + n - 1) / n).cast("long")  # noqa: E731  block k begins at ceil(k * shard_size / n_blocks)
    # an odd multiplier prime to n_blocks permutes the block numbers; the first quota % n_blocks places are taken once more
    taken_of = lambda k: (F.least(F.col("end"), begins(k + 1)) - F.greatest(F.col("start"), begins(k))) * (
        F.floor(F.col("quota") / n) + F.when(F.pmod(k * F.col("stride") + F.col("shift"), n) < F.col("quota") % n, 1).otherwise(0)
    )
    strides = F.filter(F.array(*[F.lit(p) for p in (1_000_003, 1_000_033, 1_000_037, 1_000_039, 1_000_081, 1_000_099)]), lambda p: p % n != 0)
    return (
        placed.withColumn("stride", F.coalesce(F.try_element_at(strides, F.lit(1)), F.lit(1)).cast("long"))
        .withColumn("shift", F.pmod(F.xxhash64(F.lit(seed), F.lit("blocks"), "source", "shard"), F.lit(1_000_003)))
        .withColumn(
            "taken",
            F.when((F.col("size") > 0) & (F.col("quota") > 0), F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), lambda acc, k: acc + taken_of(k).cast("long"))).otherwise(F.lit(0)).cast("long"),
        )
        .select(*[F.col(c) for c in OUTPUT], *[F.col(f"kept.`{c}`").alias(name) for c, name in zip(carry, names_beside(carry))])
    )


def names_beside(carry: tuple[str, ...]) -> list[str]:
    taken = {c.lower() for c in OUTPUT}
    out = []
    for c in carry:
        while c.lower() in taken:
            c += "_"
        taken.add(c.lower())
        out.append(c)
    return out
