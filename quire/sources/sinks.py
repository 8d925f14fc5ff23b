"""Sinks: CSV by whole rows or micro-batches, JSON, text, and block indexes kept by content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matching
from ..operators.blocking import postings
from ..operators.output import record_rows


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).csv(path, header=True, quote='"', escape='"', emptyValue="")


def write_records(parsed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parsed records in the fixed columns; without rows there is no header, and so an empty table."""
    write_csv(record_rows(parsed), path, mode)


def append_csv(rows: DataFrame, path: str) -> None:
    write_csv(rows, path, "append")


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_text(rows: DataFrame, column: str, path: str) -> None:
    rows.select(column).write.mode("overwrite").text(path)


def fingerprint(items: DataFrame, variant: str = "canonical") -> str:
    """Of the content of items, whatever their order."""
    row = items.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(items.columns)).cast("decimal(38,0)")).alias("h")).first()
    return f"{variant}-{row.n}-{row.h or 0}"


def cached_postings(items: DataFrame, folder: str, variant: str = "canonical", rebuild: bool = False) -> DataFrame:
    """The block index of items, read from folder if one of the same content is whole there, else built and written."""
    spark = items.sparkSession
    path = f"{folder.rstrip('/')}/{fingerprint(items, variant)}"
    if not rebuild and (found := load_postings(spark, path)) is not None:
        return found
    postings(items, variant).write.mode("overwrite").partitionBy("kind").parquet(path)
    return load_postings(spark, path)


def cached_index(items: DataFrame, folder: str, rebuild: bool = False) -> DataFrame:
    """What matching needs of items (`matching.index`), read from folder if it is there whole for the same content, else built and written."""
    spark = items.sparkSession
    path = f"{folder.rstrip('/')}/{fingerprint(items, 'matching')}"
    if rebuild or not whole(spark, path):
        matching.index(items, "item_index").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def whole(spark: SparkSession, path: str) -> bool:
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def load_postings(spark: SparkSession, path: str) -> DataFrame | None:
    """None if there is no whole index; TypeError if it is some other table."""
    if not whole(spark, path):
        return None
    found = spark.read.schema("key string, item_index long, kind string").parquet(path)
    columns = set(spark.read.parquet(path).columns)
    if not {"key", "item_index"} <= columns:
        raise TypeError(f"not a block index: {path}")
    return found.select("kind", "key", "item_index")


def in_batches(f: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends f of each micro-batch to a CSV folder of the batch's own number, so that a repeat replaces it."""
    return lambda batch, number: write_csv(f(batch), f"{path}/batch={number}")
