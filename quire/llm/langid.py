"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, fresh

#: Bytes of a window, and those on either side that the states of a window's ends come from.
WINDOW, LEAD = 1024, 64
#: Windows that are read side by side (fewer if probabilities of their positions are over CELLS), and bytes of text that are held at once (unless one text is longer).
LANES, CELLS, PART = 2048, 1 << 24, 1 << 21
#: Documents of the training sample over all languages, and of each language at most; windows of a document, and bytes of them.
SAMPLE, PER_LANGUAGE, PIECES, PIECE = 102_400, 400, 8, 96


@dataclass
class Model:
    """Weights of both directions: input tables (256, 3 H), recurrent (H, 3 H), and the output (H, C) each, with bias. Columns of 3 H: update gate, reset gate, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run(w: dict, rows: np.ndarray, way: str) -> tuple[list, list]:
    """Hidden states after each position of rows (n, length) in one direction ('f' or 'b'), and what backpropagation needs."""
    hidden = w["Uf"].shape[0]
    h = np.zeros((len(rows), hidden), w["Uf"].dtype)
    states: list = [None] * rows.shape[1]
    saved: list = [None] * rows.shape[1]
    for t in range(rows.shape[1]) if way == "f" else reversed(range(rows.shape[1])):
        x, a = w["X" + way][rows[:, t]], h @ w["U" + way]
        zr = sigmoid(x[:, : 2 * hidden] + a[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        c = np.tanh(x[:, 2 * hidden :] + r * a[:, 2 * hidden :])
        saved[t] = (h, z, r, c, a[:, 2 * hidden :])
        h = states[t] = c + z * (h - c)
    return states, saved


def labels(w: dict, f: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = f @ w["Of"] + b @ w["Ob"] + w["bias"]
    out = np.exp(out - out.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def gradients(w: dict, rows: np.ndarray, target: np.ndarray) -> dict:
    """Backpropagation through time of the mean cross-entropy over all positions."""
    g = {k: np.zeros_like(v) for k, v in w.items()}
    states, saved = {}, {}
    for way in "fb":
        states[way], saved[way] = run(w, rows, way)
    hidden, length = w["Uf"].shape[0], rows.shape[1]
    errors = []
    for t in range(length):
        e = labels(w, states["f"][t], states["b"][t])
        e[np.arange(len(rows)), target] -= 1
        e /= rows.size
        g["Of"] += states["f"][t].T @ e
        g["Ob"] += states["b"][t].T @ e
        g["bias"] += e.sum(axis=0)
        errors.append(e)
    for way in "fb":
        dh = np.zeros((len(rows), hidden), w["Uf"].dtype)
        for t in reversed(range(length)) if way == "f" else range(length):
            old, z, r, c, a_c = saved[way][t]
            d = dh + errors[t] @ w["O" + way].T
            dc = d * (1 - z) * (1 - c * c)
            gate = np.concatenate([d * (old - c) * z * (1 - z), dc * a_c * r * (1 - r), dc], axis=1)
            back = np.concatenate([gate[:, : 2 * hidden], dc * r], axis=1)
            np.add.at(g["X" + way], rows[:, t], gate)
            g["U" + way] += old.T @ back
            dh = d * z + back @ w["U" + way].T
    return g


def train(sample: list[tuple[str, bytes]], hidden: int = 8, steps: int = 240, batch: int = 256, length: int = 48, seed: int = 5) -> Model | None:
    """Adam over seeded batches of windows, as many from each language; None if nothing can be learnt."""
    by: dict[str, list[bytes]] = {}
    for language, piece in sorted(sample):
        if piece:
            by.setdefault(language, []).append(piece.ljust(length, b" "))
    if not by:
        return None
    names = sorted(by)
    rng = np.random.default_rng(seed)
    weight = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    w = {"bias": np.zeros(len(names), np.float32)}
    for way in "fb":
        w |= {"X" + way: weight(256, 3 * hidden, scale=0.3), "U" + way: weight(hidden, 3 * hidden, scale=hidden**-0.5), "O" + way: weight(hidden, len(names), scale=0.3)}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        target = np.arange(max(batch, len(names))) % len(names)
        drawn = []
        for i in target:
            own = by[names[i]]
            piece = own[int(rng.integers(len(own)))]
            at = int(rng.integers(len(piece) - length + 1))
            drawn.append(piece[at : at + length])
        g = gradients(w, np.frombuffer(b"".join(drawn), np.uint8).reshape(-1, length), target)
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            w[k] = (w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Model(names, w)


class Reader:
    """The network in one direction, over lanes of bytes at once: arrays of each gate, with signs and factors such that only exp is needed."""

    def __init__(self, w: dict, way: str) -> None:
        n = w["U" + way].shape[0]
        self.hidden, self.out = n, np.ascontiguousarray(w["O" + way])
        scales = (-1, -1, -2)  # sigmoid(x) is 1 / (1 + exp(-x)), and tanh(x) is 2 sigmoid(2 x) - 1
        self.x, self.u = ([np.ascontiguousarray(w[k + way][:, i * n : (i + 1) * n] * scales[i], np.float32) for i in range(3)] for k in "XU")

    def start(self, lanes: int) -> None:
        self.h = np.zeros((lanes, self.hidden), np.float32)
        self.z, self.r, self.c, self.t = (np.empty((lanes, self.hidden), np.float32) for _ in range(4))

    def step(self, column: np.ndarray) -> np.ndarray:
        h, z, r, c, t = self.h, self.z, self.r, self.c, self.t
        for gate, i in ((z, 0), (r, 1)):
            np.take(self.x[i], column, axis=0, out=gate, mode="clip")
            np.matmul(h, self.u[i], out=t)
            gate += t
            np.minimum(gate, 80, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
        np.matmul(h, self.u[2], out=t)
        t *= r
        np.take(self.x[2], column, axis=0, out=c, mode="clip")
        c += t
        np.minimum(c, 80, out=c)
        np.exp(c, out=c)
        c += 1
        np.reciprocal(c, out=c)
        c *= 2
        c -= 1
        h -= c
        h *= z
        h += c
        return h


class Labeller:
    """Labels every position of whole texts and pools the probabilities by document."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.forward, self.backward = (Reader(model.weights, way) for way in "fb")

    def windows(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Sums of the probabilities over data[start:end] of each window; states come from data[low:start] and data[end:high]."""
        n, width = len(start), int((end - start).max())
        before, after = int((start - low).max()), int((high - end).max())
        columns = data[np.minimum(np.arange(-before, width + after)[:, None] + start, len(data) - 1)]  # of negative places: never looked at
        size, reach, lead = (end - start).astype(np.int32), (high - start).astype(np.int32), (start - low).astype(np.int32)
        out = np.empty((width, len(self.model.languages), n), np.float32)
        sums = np.zeros(out.shape[1:], np.float64)
        to_f, to_b, bias = self.forward.out.T.copy(), self.backward.out.T.copy(), self.model.weights["bias"][:, None]
        least, nearest = int(size.min()), int(reach.min())
        self.forward.start(n)
        for t in range(-before, width):
            h = self.forward.step(columns[t + before])
            if t < 0:
                h[lead < -t] = 0
            else:
                np.matmul(to_f, h.T, out=out[t])
        self.backward.start(n)
        for t in range(width + after - 1, -1, -1):
            h = self.backward.step(columns[t + before])
            if t >= nearest:
                h[t >= reach] = 0
            if t < width:
                p = out[t]
                p += to_b @ h.T
                p += bias
                np.minimum(p, 60, out=p)
                np.exp(p, out=p)
                p /= p.sum(axis=0)
                if t >= least:
                    p *= t < size
                sums += p
        return sums.T

    def documents(self, texts: pa.Array) -> pa.Array:
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(pc.fill_null(texts, ""))
        off = np.frombuffer(low.buffers()[1], np.int32)[low.offset : low.offset + len(low) + 1].astype(np.int64)
        data = np.frombuffer(low.buffers()[2] or b"", np.uint8)
        size = np.where(lettered, np.diff(off), 0)
        number = -(-size // WINDOW)
        doc = np.repeat(np.arange(len(size)), number)
        start = off[doc] + WINDOW * (np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number))
        end = np.minimum(start + WINDOW, off[doc + 1])
        first, last = np.maximum(start - LEAD, off[doc]), np.minimum(end + LEAD, off[doc + 1])
        pooled = np.zeros((len(size), len(self.model.languages)))
        order = np.argsort(start - end, kind="stable")  # windows of like length side by side
        lanes = max(8, min(LANES, CELLS // (WINDOW * len(self.model.languages))))
        for at in range(0, len(order), lanes):
            own = order[at : at + lanes]
            np.add.at(pooled, doc[own], self.windows(data, start[own], end[own], first[own], last[own]))
        share = pooled / np.maximum(size, 1)[:, None]
        best = share.argmax(axis=1)
        names = np.array([*self.model.languages, "und"], object)
        return pa.StructArray.from_arrays(
            [pa.array(names[np.where(lettered, best, len(names) - 1)], pa.string()), pa.array(np.where(lettered, np.minimum(share[np.arange(len(best)), best], 1.0), 0.0))], ["lang", "score"]
        )


def predictor(model: Model | None):
    """A column function: text to struct<lang,score>; `und` with score 0 for null text, text without a letter, or without a model."""
    if model is None:
        return lambda text: F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model)
        for texts in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            found, at = [labeller.documents(texts[:0])], 0
            while at < len(texts):
                stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, side="right")), at + 1)
                found.append(labeller.documents(texts.slice(at, stop - at)))
                at = stop
            yield pa.concat_arrays(found)

    return predict


def sample_windows(docs: DataFrame, seed: int = 5) -> list[tuple[str, bytes]]:
    """A bounded sample of labelled windows: in expectation PER_LANGUAGE documents of each language and SAMPLE of all (but at least four of each language), drawn
    by a hash of doc_id, and of each PIECES windows of PIECE bytes from anywhere in its whole text."""
    counts = docs.where(F.col("lang").isNotNull()).groupBy("lang").count().collect()
    if not counts:
        return []
    most = max(4, min(PER_LANGUAGE, SAMPLE // len(counts)))
    share = F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(min(1.0, most / r["count"])))])
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    picked = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(drawn < F.try_element_at(share, F.col("lang"))).select("lang", "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = []
            for language, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.lower().encode()
                rng = np.random.default_rng([seed, len(raw), len(text)])
                most = len(raw) - PIECE
                out += [(language, raw[i : i + PIECE]) for i in (rng.integers(0, most + 1, PIECES).tolist() if most > 0 else [0])]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary())], ["lang", "piece"])

    return [(r.lang, bytes(r.piece)) for r in picked.mapInArrow(pieces, "lang string, piece binary").collect()]


def learn(docs: DataFrame) -> Model | None:
    """A model of docs (doc_id, text, lang); None if no text has a language. Null texts and languages teach nothing; repeated rows are drawn together."""
    return train(sample_windows(docs))


def identify(docs: DataFrame, model: Model | None, text: Column | None = None) -> DataFrame:
    """docs with lang_pred and score added; columns of these names are replaced, all others stay.

    Every position (byte of the lower-cased text) of the whole text is labelled by both directions of the network; the document's probabilities are the mean
    over its positions. The recurrence runs over the text in windows of WINDOW bytes; a window's states begin LEAD bytes before (backwards: after) it, so that
    they are carried over its ends and long texts are many windows side by side. Null text, text
    without a letter and empty text: `und` with score 0. Ties go to the language that sorts first. Repeated rows are labelled alike. No rows: no rows.
    """
    (found,) = fresh(docs, "found")
    marked = docs.withColumn(found, predictor(model)(F.col("text") if text is None else text))
    return marked.withColumn("lang_pred", F.col(f"{found}.lang")).withColumn("score", F.col(f"{found}.score")).drop(found)


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside fold 2 of 4 and predicts all rows: doc_id, held_out, lang_pred, score."""
    marked = docs.select("doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = learn(marked.where(~F.col("held_out")))
    return identify(marked.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")
