"""A training corpus from documents: language ID, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontam, langid, lines, mixing, simhash
from quire.llm.common import fold, fresh, materialize, table

#: Documents whose best language has less than this share of their positions are of no language.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no one language, by a model of the rows outside fold 2 of 4.

    Null and empty texts have no letter and go. Where no row has a language nothing is learnt, and all other rows stay. Repeated rows stay or go
    together. No rows: no rows. Other columns of any name stay as they are.
    """
    model = langid.learn(docs.where(fold(F.col("doc_id"), 4) != 2))
    if model is None:  # nothing was learnt, so nothing can be rejected but texts without a letter
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    (found,) = fresh(docs, "found")
    marked = docs.withColumn(found, langid.predictor(model)(F.col("text")))
    return marked.where((F.col(f"{found}.lang") != "und") & (F.col(f"{found}.score") >= LEAST_SCORE)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated and nearly repeated lines out of the texts, the first by doc_id staying; n_chars is that of what is left.

    No row goes. Null and empty texts stay as they are, a text of repeated lines alone is left empty. Rows that agree in doc_id and text are one
    document. No rows: no rows. Other columns, also n_lines and n_dropped, stay as they are.
    """
    (inner,) = fresh(docs, "others")
    others = F.struct(F.lit(0).alias(fresh(docs, "none")[0]), *[F.col(c) for c in docs.columns if c.lower() not in ("text", "doc_id")])
    cleaned = lines.dedup(docs.select("doc_id", "text", others.alias(inner)))
    n_chars = F.length("text").cast("long")
    return cleaned.select(*[n_chars.alias(c) if c.lower() == "n_chars" else F.col(c) if c.lower() in ("doc_id", "text") else F.col(f"{inner}.`{c}`").alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the least doc_id's; null ids come last.

    Texts without words, null ones too, are copies of each other. Of rows that agree in doc_id and text one stays; others of one doc_id are other
    documents. No rows: no rows. Other columns of any name stay as they are.
    """
    return simhash.without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage: all rows of a doc_id of which one does.

    Null and empty texts hold none; an empty benchmark drops nothing. No rows: no rows. Other columns of any name stay as they are.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken: how many of their words it takes, repeats counted.

    Texts without words, null ones too, have nothing to take and go. A null source is a source of its own. Repeated rows each count. No rows: no
    rows. Other columns stay; those named like one of the added ones get underscores at their end.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    return mixing.mix(docs, carry=rest).where(F.col("taken") > 0).drop("n_blocks")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: SQL can't express a network's predictions; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet into the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
