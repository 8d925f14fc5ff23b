"""Language-model scoring: a gated recurrent network over words with a class-factored softmax, trained in numpy."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize

#: Words with an output of their own; words whose corpus counts are broadcast; classes of output words, besides that of the rest.
SHORTLIST, BROADCAST, CLASSES = 4096, 65_536, 64
#: Tokens of a window of truncated backpropagation, lanes of text side by side in training and in scoring.
WINDOW, LANES, SCORE_LANES = 32, 48, 512
#: Tokens that a worker gathers before it scores them, and distinct words before it hands on their counts.
GATHERED, COUNTED = 1_500_000, 400_000
#: Parts of the training texts after which the workers' weights are averaged, tokens that a worker learns from at once, lanes and rate of that learning.
ROUNDS, LEARNT, LEARN_LANES, RATE = 4, 400_000, 256, 0.003
END = 0


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    out = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text))
            if len(counts) > COUNTED:
                yield out()
                counts.clear()
    yield out()


@dataclass
class Counts:
    """Of the training tokens: all, distinct ones, documents, and the most frequent words with their counts."""

    total: int
    distinct: int
    documents: int
    words: list[bytes]
    counts: np.ndarray


@dataclass
class Model:
    counts: Counts
    classes: np.ndarray  # class of each shortlisted id; id 0 is the end
    bounds: np.ndarray  # first id of each class, and their end
    w: dict[str, np.ndarray]


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """Ids 1.. by falling count in classes of about equal mass; the end, id 0, is a class of its own."""
    share = np.cumsum(np.sqrt(counts[1:]))
    place = np.minimum((share / share[-1] * classes).astype(int), classes - 1) if len(share) else np.zeros(0, int)
    return np.r_[0, np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) + 1 if len(place) else [], len(counts)].astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def step(w: dict, x: np.ndarray, h: np.ndarray) -> tuple:
    n = h.shape[1]
    a = h @ w["U"]
    zr = sigmoid(x[:, : 2 * n] + a[:, : 2 * n])
    z, r = zr[:, :n], zr[:, n:]
    c = np.tanh(x[:, 2 * n :] + r * a[:, 2 * n :])
    return c + z * (h - c), z, r, c, a[:, 2 * n :]


def soft(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def by_class(cls: np.ndarray, classes: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(cls, kind="stable")
    ends = np.searchsorted(cls[order], np.arange(classes + 1))
    for c in range(classes):
        if ends[c] < ends[c + 1]:
            yield c, order[ends[c] : ends[c + 1]]


def log_probabilities(model: Model, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logs of P(class | h) P(word | class, h); ids beyond the shortlist get the class of the rest alone."""
    w, bounds = model.w, model.bounds
    rest = len(bounds) - 1
    cls = np.where(ids < len(model.classes), model.classes[np.minimum(ids, len(model.classes) - 1)], rest)
    out = h @ w["C"] + w["c"]
    top = out.max(axis=1)
    p = out[np.arange(len(ids)), cls] - top - np.log(np.exp(out - top[:, None]).sum(axis=1))
    for c, at in by_class(cls, rest):
        lo, hi = bounds[c], bounds[c + 1]
        if hi - lo > 1:
            out = h[at] @ w["O"][lo:hi].T + w["o"][lo:hi]
            top = out.max(axis=1)
            p[at] += out[np.arange(len(at)), ids[at] - lo] - top - np.log(np.exp(out - top[:, None]).sum(axis=1))
    return p


def train(counts: Counts, texts: list[list[bytes]], hidden: int = 24, passes: int = 3, seed: int = 3, start: Model | None = None, most: float = 0.01, lanes_: int = LANES) -> Model:
    """Truncated backpropagation in lanes of whole texts, the state carried from window to window; Adam. Goes on from `start`, if given."""
    short = np.r_[counts.documents, counts.counts[: SHORTLIST - 1]]
    bounds = class_bounds(short, CLASSES)
    classes = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    rng = np.random.default_rng(seed)
    k, n_classes = len(short), len(bounds)
    mass = np.r_[np.add.reduceat(short, bounds[:-1]), max(counts.total - short.sum(), 0)] + 0.5
    w = {
        "X": rng.standard_normal((k + 1, 3 * hidden)) * 0.1, "U": rng.standard_normal((hidden, 3 * hidden)) * hidden**-0.5,
        "C": np.zeros((hidden, n_classes)), "c": np.log(mass / mass.sum()), "O": np.zeros((k, hidden)), "o": np.log(short + 0.5),
    }
    w = {name: x.astype(np.float32) for name, x in w.items()} if start is None else {name: x.copy() for name, x in start.w.items()}
    hidden = len(w["U"])
    model = Model(counts, classes, bounds, w)
    known = {x: i + 1 for i, x in enumerate(counts.words[: SHORTLIST - 1])}
    m, v = ({name: np.zeros_like(x) for name, x in w.items()} for _ in range(2))
    total_steps, now = None, 0
    for _ in range(passes):
        stream: list[int] = []
        for t in rng.permutation(len(texts)):
            stream += [known.get(x, k) for x in texts[t]]
            stream.append(END)
        n_lanes = max(1, min(lanes_, len(stream) // WINDOW))
        length = -(-len(stream) // n_lanes)
        if not length:
            return model
        lanes = np.array(stream + [END] * (length * n_lanes - len(stream)), np.int64).reshape(n_lanes, length).T
        total_steps = total_steps or passes * (length // WINDOW + 1)
        h = np.zeros((n_lanes, hidden), np.float32)
        for at in range(0, length, WINDOW):
            now += 1
            ids = lanes[at : at + WINDOW]
            states, saved = [], []
            for t in range(len(ids)):
                states.append(h)
                new, *inner = step(w, w["X"][ids[t]], h)
                saved.append((h, *inner))
                h = np.where((ids[t] == END)[:, None], np.float32(0), new)
            flat, target = np.concatenate(states), ids.ravel()
            g = {name: np.zeros_like(x) for name, x in w.items()}
            cls = np.where(target < k, classes[np.minimum(target, k - 1)], n_classes - 1)
            e = soft(flat @ w["C"] + w["c"])
            e[np.arange(len(target)), cls] -= 1
            e /= len(target)
            g["C"], g["c"] = flat.T @ e, e.sum(axis=0)
            dh = e @ w["C"].T
            for c, rows in by_class(cls, n_classes - 1):
                lo, hi = bounds[c], bounds[c + 1]
                if hi - lo > 1:
                    e = soft(flat[rows] @ w["O"][lo:hi].T + w["o"][lo:hi])
                    e[np.arange(len(rows)), target[rows] - lo] -= 1
                    e /= len(target)
                    g["O"][lo:hi], g["o"][lo:hi] = e.T @ flat[rows], e.sum(axis=0)
                    dh[rows] += e @ w["O"][lo:hi]
            dh = dh.reshape(len(ids), n_lanes, hidden)
            carry = np.zeros((n_lanes, hidden), np.float32)
            for t in reversed(range(len(ids))):
                old, z, r, c, a_c = saved[t]
                d = np.where((ids[t] == END)[:, None], np.float32(0), carry)
                dc = d * (1 - z) * (1 - c * c)
                gate = np.concatenate([d * (old - c) * z * (1 - z), dc * a_c * r * (1 - r), dc], axis=1)
                back = np.concatenate([gate[:, : 2 * hidden], dc * r], axis=1)
                np.add.at(g["X"], ids[t], gate)
                g["U"] += old.T @ back
                carry = d * z + back @ w["U"].T + dh[t]
            rate = most * min(1.0, 2 * (1 - now / (total_steps + 1)))
            for name in w:
                m[name] += 0.1 * (g[name] - m[name])
                v[name] += 0.01 * (g[name] ** 2 - v[name])
                w[name] -= rate * (m[name] / (1 - 0.9**now)) / (np.sqrt(v[name] / (1 - 0.99**now)) + 1e-7)
    return model


def learner(model: Model):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> weights, n: the model's weights after one pass over all texts of the task, and how many tokens it has read."""
        now, held, n, total = model, [], 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(words_of(text))
                n += len(held[-1]) + 1
                if n >= LEARNT:
                    now, held, n, total = train(model.counts, held, passes=1, start=now, most=RATE, lanes_=LEARN_LANES), [], 0, total + n
        if held:
            now, total = train(model.counts, held, passes=1, start=now, most=RATE, lanes_=LEARN_LANES), total + n
        if total:
            yield packed(now.w, total)

    return learn


def packed(w: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    flat = np.concatenate([w[name].ravel() for name in sorted(w)]).astype(np.float32)
    return pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["weights", "n"])


def mean(rows: Iterator[tuple[bytes, int]]) -> tuple[np.ndarray, int]:
    """Mean of weights by tokens."""
    flat, total = np.zeros(0), 0
    for weights, n in rows:
        x = np.frombuffer(weights, np.float32) * float(n)
        flat, total = (flat + x if total else x), total + n
    return flat / max(total, 1), total


def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flat, total = mean((w, n) for batch in batches for w, n in zip(*(c.to_pylist() for c in batch.columns)))
    if total:
        yield packed({"": flat}, total)


def averaged(model: Model, docs: DataFrame) -> Model:
    """The model after one pass over all texts of docs (doc_id, text), in ROUNDS parts by a hash of doc_id: the tasks of a part begin with the same
    weights, and their means by tokens are what the next part begins with. The driver gets 16 rows of weights a part."""
    for part in range(ROUNDS):
        some = docs.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(ROUNDS)) == part).select("text")
        rows = some.mapInArrow(learner(model), "weights binary, n long").repartition(16).mapInArrow(means, "weights binary, n long").collect()
        flat, total = mean((bytes(r.weights), r.n) for r in rows)
        if total:
            names = sorted(model.w)
            ends = np.cumsum([model.w[name].size for name in names])[:-1]
            w = {name: x.astype(np.float32).reshape(model.w[name].shape) for name, x in zip(names, np.split(flat, ends))}
            model = Model(model.counts, model.classes, model.bounds, w)
    return model


def document_scores(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihoods of whole documents (ids with the end last), read in lanes whose state goes on over windows."""
    w, hidden = model.w, model.w["U"].shape[0]
    sizes = np.array([len(d) for d in docs])
    lanes: list[list[int]] = [[] for _ in range(max(1, min(SCORE_LANES, len(docs))))]
    loads = np.zeros(len(lanes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        j = int(loads.argmin())
        lanes[j].append(i)
        loads[j] += sizes[i]
    order = np.argsort(-loads, kind="stable")
    length = int(loads.max())
    active = np.searchsorted(-loads[order], -np.arange(length), side="left")
    flat = np.concatenate([docs[i] for j in order for i in lanes[j]])
    owner = np.concatenate([np.full(sizes[i], i) for j in order for i in lanes[j]])
    begin = np.cumsum(loads[order]) - loads[order]
    out, h = np.zeros(len(docs)), np.zeros((len(lanes), hidden), np.float32)
    unknown = len(w["X"]) - 1
    window = 64
    for at in range(0, length, window):
        states, ids, owners = [], [], []
        for t in range(at, min(at + window, length)):
            n = active[t]
            place = begin[:n] + t
            x = flat[place]
            states.append(h[:n])
            new = step(w, w["X"][np.minimum(x, unknown)], h[:n])[0]
            new[x == END] = 0
            h = new
            ids.append(x)
            owners.append(owner[place])
        p = log_probabilities(model, np.concatenate(states), np.concatenate(ids))
        out += np.bincount(np.concatenate(owners), p, len(docs))
    return out


def scorer(model: Model):
    """Rows (doc_id, held_out, text) -> doc_id, held_out, n_tokens, n_known, base, score (natural logs, without the counts of rare words) and rare: the
    words whose counts aren't broadcast."""
    counts = model.counts
    rare = len(counts.words) + 1
    logs = np.log(np.r_[counts.documents, counts.counts, 0] + 0.5)
    logs[-1] = 0
    short = len(model.classes)
    rest, distinct_rest = counts.total - counts.documents - counts.counts[: short - 1].sum(), counts.distinct - short
    per_base, per_rest = np.log(counts.total + 0.5 * (counts.distinct + 1)), np.log(max(rest + 0.5 * (distinct_rest + 1), 0.5))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {x: i + 1 for i, x in enumerate(counts.words)}

        def flush(rows: list, folds: list, docs: list, unknown: list) -> pa.RecordBatch:
            sizes = np.array([len(d) for d in docs])
            at = np.cumsum(sizes) - sizes
            flat = np.concatenate(docs)
            found = np.add.reduceat(logs[flat], at)
            other = np.add.reduceat((flat >= short).astype(np.int64), at)
            base = found - sizes * per_base
            outside = np.add.reduceat(np.where(flat >= short, logs[flat], 0), at)
            known_ = np.add.reduceat(((flat < rare) & (flat > 0) | (flat == END) & (counts.documents > 0)).astype(np.int64), at)
            own = document_scores(model, [np.minimum(d, short) for d in docs]) + outside - other * per_rest
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(folds, pa.bool_()), pa.array(sizes), pa.array(known_), pa.array(base), pa.array(own), pa.array(unknown, pa.list_(pa.binary()))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "own", "rare"],
            )

        rows: list = []
        folds: list = []
        docs: list = []
        unknown: list = []
        gathered = 0
        for batch in batches:
            for row, held_out, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                ids = [known.get(x, rare) for x in words]
                rows.append(row)
                folds.append(held_out)
                unknown.append([x for x, i in zip(words, ids) if i == rare])
                docs.append(np.array([*ids, END], np.int32))
                gathered += len(words) + 1
                if gathered > GATHERED:
                    yield flush(rows, folds, docs, unknown)
                    rows, folds, docs, unknown, gathered = [], [], [], [], 0
        if rows:
            yield flush(rows, folds, docs, unknown)

    return score


def corpus_counts(docs: DataFrame) -> tuple[DataFrame, Counts]:
    """Counts of every word of docs (text), as a table and as the driver's summary, which holds BROADCAST words at most."""
    table = docs.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    table = materialize(table, "lm-counts")
    sums = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    documents = docs.count()
    top = table.orderBy(F.desc("n"), "word").limit(BROADCAST).collect()
    return table, Counts(sums.n + documents, sums.words + (documents > 0), documents, [bytes(r.word) for r in top], np.array([r.n for r in top], np.int64))


def sample(docs: DataFrame, tokens: int, documents: int, seed: int = 3) -> list[list[bytes]]:
    """At most `documents` whole texts, drawn by a hash of doc_id, up to about `tokens` tokens in all (the last may pass it).

    The sample alone leaves out texts of over 40 * tokens characters, which the driver would have to hold.
    """
    share = documents / max(documents, docs.count())
    drawn = F.xxhash64(F.lit(seed), "doc_id")
    rows = docs.where(F.pmod(drawn, F.lit(1_000_003)) < share * 1_000_003 + 1).where(F.length("text") < 40 * tokens).select("text", drawn.alias("at")).orderBy("at", "text").limit(documents).toLocalIterator()
    texts, left = [], tokens
    for r in rows:
        texts.append(words_of(r.text))
        left -= len(texts[-1]) + 1
        if left <= 0:
            break
    return texts


def held_out_scores(docs: DataFrame, tokens: int = 400_000, documents: int = 2_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row of docs (doc_id, text).

    Learns from the rows outside fold 1 of 5: words are counted over all of them; the network begins with weights trained on at most
    `documents` whole texts of about `tokens` tokens, and then learns from all texts (`averaged`). A token's probability is that of its class times that of the word
    in its class, both by the network's state, for the SHORTLIST most frequent tokens; for all others it is that of the class
    of the rest times the word's share of the rest's counts, smoothed by a half. Counts of the BROADCAST most frequent
    words go to the workers; rarer words, none of which is frequent, are joined to the table of counts.

    Null, empty and blank texts are the end alone. Repeated rows are each counted, scored and returned. No training rows: every
    token is unknown. No rows: no rows. Other columns are not looked at.
    """
    marked = docs.select("doc_id", "text", (fold(F.col("doc_id"), 5) == 1).alias("held_out"))
    training = marked.where(~F.col("held_out"))
    table, counts = corpus_counts(training)
    model = averaged(train(counts, sample(training, tokens, documents)), training)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, rare array<binary>"
    narrow = marked.select(F.col("doc_id").cast("long"), "held_out", "text")
    scored = materialize(narrow.mapInArrow(scorer(model), schema).withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rest = scored.select("row", F.explode("rare").alias("word")).join(table, "word", "left")
    known = rest.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("more"))
    log10 = lambda x: (F.col(x) + F.coalesce("logs", F.lit(0.0))) / F.log(F.lit(10.0))
    return scored.drop("rare").join(known, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(counts.total).cast("long").alias("train_tokens"), log10("base").alias("base_score"), log10("own").alias("score")
    )
