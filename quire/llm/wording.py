"""Words of whole batches of texts as arrays of hashes, and fingerprints of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are held at once, unless one text is longer.
PART = 1 << 17
#: Names that a task remembers as seen; the store is emptied when it is full.
SEEN = 500_000
#: Bytes that part words: all ASCII but letters and digits; the space and the control characters from tab to carriage return.
SIGNS, BLANKS = np.zeros(256, bool), np.zeros(256, bool)
SIGNS[[c for c in range(128) if not chr(c).isalnum()]] = True
BLANKS[[9, 10, 11, 12, 13, 32]] = True
#: For each byte, its bits as eight counters of eight bits.
SPREAD = np.array([sum(1 << (8 * i) for i in range(8) if b >> i & 1) for b in range(256)], np.uint64)
#: Odd multipliers of the hashes of byte and word sequences.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of an odd number modulo 2 ** 64 and of its inverse, as many as asked for."""

    def __init__(self, base: int) -> None:
        self.bases, self.tables = (base, pow(base, -1, 1 << 64)), [np.ones(1, np.uint64)] * 2

    def __call__(self, n: int) -> list[np.ndarray]:
        if n > len(self.tables[0]):
            for k, base in enumerate(self.bases):
                steps = np.full(max(n, PART), base, np.uint64)
                steps[0] = 1
                self.tables[k] = np.multiply.accumulate(steps)
        return self.tables


POWERS = [Powers(base) for base in BASES]


def sequences(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of values[start:end], which don't depend on where the range begins."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


def words_of(texts: pa.Array, apart: np.ndarray = SIGNS) -> tuple[np.ndarray, ...]:
    """Of all words of the texts: 64-bit hash and length in bytes, number of the line among all lines; of all lines: text and place in it.

    Words are parted by the bytes that `apart` marks. All arrays at once: nothing is done word by word."""
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    off -= off[0]
    parting = apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begins, ends = ~parting, ~parting
    begins[1:] &= parting[:-1] | edge[1:-1]
    ends[:-1] &= parting[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = mixed(sequences(data.astype(np.uint64) + np.uint64(1), start, end, POWERS[0]))
    breaks = np.flatnonzero(data == 10) + 1
    bounds = np.concatenate([breaks, off[:-1]])
    order = np.argsort(bounds, kind="stable")  # a line that a break ends comes before a text that begins there
    opens = order >= len(breaks)
    text = np.cumsum(opens) - 1
    no = np.arange(len(bounds)) - np.flatnonzero(opens)[text]
    return hashes, end - start, np.searchsorted(bounds[order], start, side="right") - 1, text, no


def parts(batch: pa.RecordBatch, column: int, lower=pc.utf8_lower) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with their lower-cased texts, of about PART bytes."""
    texts = lower(pc.fill_null(batch.column(column), ""))
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    at = 0
    while at < len(texts):
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, side="right")), at + 1)
        yield batch.slice(at, stop - at), texts.slice(at, stop - at)
        at = stop


def prints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of lines from the hashes of all their words: bits set in over half of them. Sizes are over 0.

    Counters of eight bits hold 255 words, so that longer lines are counted in pieces.
    """
    pieces = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    starts = (np.cumsum(sizes) - sizes)[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    of_byte = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    counts = np.empty((len(starts), 8), np.uint64)
    for j in range(8):
        counts[:, j] = np.add.reduceat(SPREAD[of_byte[:, j]], starts)
    ones = counts.view(np.uint8)
    if len(starts) > len(sizes):
        ones = np.add.reduceat(ones, np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)
    return np.packbits(2 * ones.astype(np.int64) > sizes[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def unseen(seen: set, names: np.ndarray) -> np.ndarray:
    """Which of the names a task hasn't seen lately."""
    if len(seen) > SEEN:
        seen.clear()
    return np.fromiter((not (x in seen or seen.add(x)) for x in names.tolist()), bool, len(names))
