"""The opN_ queries over the tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, langid, lines, lm, mixing, secrets, simhash, substrings, urls
from .common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_predictions(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.labels_by_number(pages, table(spark, sf_dir, "labels")))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language_id": op2_language_id,
    "op3_lm_score": op3_lm_score,
    "op4_nearest": op4_nearest,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_simhash": op7_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_mix_sources": op10_mix_sources,
}

ORACLE_SQL: dict[str, str] = {}
