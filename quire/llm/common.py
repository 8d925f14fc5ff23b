"""What the operators of this subpackage share: materialised intermediates, word counting, fold arithmetic, names that can't clash, bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import materialize, release, shared_dir  # noqa: F401  for the operators of this folder

#: A word is a run of anything but the space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
#: Bits of a bitmap of keys: 4 MB, whatever the number of keys.
BITS = 1 << 25


def small_frame(spark: SparkSession, columns: dict, schema: pa.Schema) -> DataFrame:
    """A frame made of columns held by the driver, whose size the caller has bounded."""
    return spark.createDataFrame(pa.table(columns, schema=schema))


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; null keys are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_tag(*columns: Column) -> Column:
    """A number for the contents of a row: rows that agree in these columns are one document."""
    return F.xxhash64(*columns)


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """BITS bits, one set for each key: a fixed size on the driver, and no key is ever told from its neighbours."""
    bit = F.pmod(F.col(key), F.lit(BITS))
    rows = keys.select(F.floor(bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST(pmod({key}, 64) AS INT))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def held_by(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the bits of the keys (uint64)."""
    return (bits[(keys % np.uint64(BITS) >> np.uint64(6)).astype(np.int64)] >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)


def maybe_in(bits: np.ndarray):
    """A column function of a long: false only where the key isn't among those of the bitmap."""

    @F.arrow_udf("boolean")
    def maybe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(held_by(bits, keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))

    return maybe
