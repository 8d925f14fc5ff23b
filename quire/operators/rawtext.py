"""Raw-text records, the common form of all extractors, to bibliographic records with a parsing status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty
from ..sources.schemas import BIB_ITEM, RAW_TEXT
from .crossref import status

FIELDS = ("raw_text", "type", "title", "year", "pubstate", "authors", "editors", "journal", "volume", "issue_number", "start_page", "end_page", "publisher", "doi", "url")


def convert(raw: DataFrame) -> DataFrame:
    """raw (the columns of RAW_TEXT) with parsing_status, message, context and out.

    Editors stand in for missing authors and are lost otherwise; a record without a title is an error; the type of a
    record without one is UNKNOWN; pages need a first page; year 0 is no date.
    """
    people = lambda c: F.transform(c, lambda a: F.struct(F.coalesce(a["given"], F.lit("")).alias("given"), F.coalesce(a["family"], F.lit("")).alias("family")))
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    authors = F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.coalesce("editors", F.array()))
    start = nonempty(F.col("start_page"))
    record = F.struct(
        F.coalesce(nonempty(F.col("type")), F.lit("UNKNOWN")).alias("entry_type"), F.lit(None).cast("string").alias("bibkey"), people(authors).alias("author"), F.col("title"),
        F.when(F.col("year") != 0, F.col("year")).alias("year"), empty("pubstate").alias("pubstate"), nonempty(F.col("journal")).alias("journal"), F.lit("").alias("issn_print"), F.lit("").alias("issn_electronic"),
        empty("volume").alias("volume"), empty("issue_number").alias("number"),
        F.when(start.isNull(), F.array()).otherwise(F.array(F.struct(start.alias("start"), empty("end_page").alias("end")))).alias("pages"),
        empty("publisher").alias("publisher"), empty("doi").alias("doi"), empty("url").alias("url"), F.lit("RawText (LLM)").alias("source"),
    ).cast(BIB_ITEM)
    problem = F.when(nonempty(F.col("title")).isNull(), "title is required but was not found in the raw text")
    return status(raw.withColumn("_problem", problem), record, F.to_json(F.struct(*FIELDS)))


def from_json_files(spark, path: str) -> DataFrame:
    """Records of JSON files that hold an object or an array; unknown fields are ignored."""
    return spark.read.schema(RAW_TEXT).option("multiLine", True).json(path)


def parse_answers(answers: DataFrame, column: str = "answer") -> DataFrame:
    """Records of model answers, JSON text with an object, an array, or an object with `items`."""
    listed = F.coalesce(F.get_json_object(column, "$.items"), F.col(column))
    wrapped = F.when(F.trim(listed).startswith("["), listed).otherwise(F.concat(F.lit("["), listed, F.lit("]")))
    return answers.select(F.explode(F.from_json(wrapped, f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in split_fields(RAW_TEXT))}>>")).alias("r")).select("r.*")


def split_fields(ddl: str) -> list[str]:
    out, depth, last = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(ddl[last:i].strip())
            last = i + 1
    return [*out, ddl[last:].strip()]
