"""Substring dedup by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap, fresh, materialize, maybe_in, row_tag

#: Bytes that the rolling hash looks back, mean and least and largest length of a chunk.
WINDOW, MEAN, LEAST, MOST = 16, 32, 8, 1024
#: Seeded gear table: a 16-bit value for each byte.
GEAR = np.random.default_rng(20_011).integers(0, 1 << 16, 256, dtype=np.uint16)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions after which the gear hash of the last WINDOW bytes allows a cut, never inside a character.

    h[i] = sum of GEAR[data[i - j]] << j over the window, built by doubling.
    """
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint16(width)
    ends = np.flatnonzero(h < (1 << 16) // MEAN) + 1
    return ends[(data[np.minimum(ends, len(data) - 1)] & 0xC0) != 0x80]


def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, tag, text -> doc_id, tag, no, start, end (code points), first_word, last_word, digest."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        row, digests, nos, starts = [], [], [], []
        for k, text in enumerate(batch.column(2).to_pylist()):
            if not text:
                continue
            raw = text.encode()
            data = np.frombuffer(raw, np.uint8)
            last, own = 0, []
            for at in [*cuts(data).tolist(), len(raw)]:
                while at - last > MOST:
                    step = last + MOST
                    while raw[step] & 0xC0 == 0x80:
                        step -= 1
                    own.append((last, step))
                    last = step
                if at - last >= LEAST or at == len(raw) and at > last:
                    own.append((last, at))
                    last = at
            a, b = np.array([x for x, _ in own]), np.array([x for _, x in own])
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            words = np.r_[0, np.cumsum(~BLANK[data] & np.r_[True, BLANK[data[:-1]]])]
            starts.append(np.stack([points[a], points[b], words[a], words[b]]))
            digests += [digest(raw[x:y]) for x, y in own]
            nos.append(np.arange(len(own), dtype=np.int32))
            row.append(np.full(len(own), k))
        if row:
            place = np.concatenate(starts, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(np.concatenate(row))) for c in (0, 1)), *(pa.array(x) for x in (np.concatenate(nos), *place)), pa.array(np.array(digests, np.uint64).view(np.int64))],
                ["doc_id", "tag", "no", "start", "end", "first_word", "last_word", "digest"],
            )


def repeats(docs: DataFrame, least_words: int = 20, within: bool = False) -> DataFrame:
    """doc_id, start, end (code points, end exclusive), n_words, copies, first, tag of the parts of passages that occur in several documents, or, with `within`, at several places.

    Every whole text is cut where a hash of the last bytes says so, so that an insertion moves the cuts around it and no
    others. A chunk is repeated if several documents hold its digest (with `within`: if it is at several places, be they in one document); a run of repeated
    chunks is a passage if it touches more than least_words words. A passage is given in parts: of those with first, this document (place) is the first of every
    chunk, by doc_id and tag (and position); all others may go, as their chunks stay elsewhere. n_words is that of the part; copies: the largest number of a chunk's places. Digests are counted
    before they are shuffled, only rows that may have a repeated digest (by a bitmap of fixed size) are moved, and the join back is on the side that adaptive execution can split.

    Null, empty and short texts have no passage. tag is a hash of doc_id and text: rows that agree in both are one document, and no repeats of
    each other; others of one doc_id are others. Null doc_ids come first. No rows: no rows. Other columns, whatever their names, are not looked at.
    """
    named = docs.select(F.col("doc_id").cast("long"), row_tag(F.col("doc_id").cast("long"), F.col("text")).alias("tag"), "text")
    schema = "doc_id long, tag long, no int, start int, end int, first_word int, last_word int, digest long"
    chunks = materialize(named.mapInArrow(chunk, schema), "chunks")
    often = materialize(chunks.groupBy("digest").count().where("count > 1").select("digest"), "chunks-often")
    some = chunks.where(maybe_in(bitmap(often, "digest"))(F.col("digest")))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tag", *(["no"] if within else []))
    known = some.groupBy("digest").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count("*").alias("copies"))
    repeated = known.where("least <> most").select("digest", "least", "copies")
    at = ["doc_id", "tag"]
    runs, parts = Window.partitionBy(*at).orderBy("no"), Window.partitionBy(*at, "island", "first").orderBy("no")
    passage = Window.partitionBy(*at, "island")
    own = some.join(repeated, "digest").select(*at, "no", "start", "end", "first_word", "last_word", "copies", (F.col("least") == place).alias("first"))
    return (
        own.withColumn("island", F.col("no") - F.dense_rank().over(runs))
        .withColumn("touched", F.max("last_word").over(passage) - F.min("first_word").over(passage))
        .where(F.col("touched") > least_words)
        .withColumn("part", F.col("no") - F.dense_rank().over(parts))
        .groupBy(*at, "island", "first", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("last_word") - F.min("first_word")).cast("long").alias("n_words"), F.max("copies").alias("copies"))
        .select("doc_id", "start", "end", "n_words", "copies", "first", "tag")
    )


def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the spans [start, end) of their sorted lists."""
    out = []
    for text, spans in zip(texts.to_pylist(), gone.to_pylist()):
        if spans:
            bounds = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
            text = "".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
        out.append(text)
    return pa.array(out, pa.string())


def remove(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs with the passages that aren't first cut out of the text. Null and empty texts stay, a text of passages alone is left empty; all other columns, whatever their names, stay as they are."""
    tag, key, mark, gone_ = fresh(docs, "tag", "key", "mark", "gone")
    gone = passages.where(~F.col("first")).groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(gone_))
    gone = materialize(gone.select(F.col("doc_id").alias(key), F.col("tag").alias(mark), gone_), "chunks-gone")
    long_id = F.col("doc_id").cast("long")
    marked = docs.withColumn(tag, row_tag(long_id, F.col("text")))
    touched = maybe_in(bitmap(gone, mark))(F.col(tag))
    rest = marked.where(touched).join(gone, (F.col(tag) == F.col(mark)) & long_id.eqNullSafe(F.col(key)), "left").withColumn("text", F.arrow_udf(cut, "string")("text", gone_))
    return marked.where(~touched).select(docs.columns).unionByName(rest.select(docs.columns))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """docs with each repeated passage kept at its first place alone; see `repeats` and `remove`."""
    return remove(docs, repeats(docs, **options))
