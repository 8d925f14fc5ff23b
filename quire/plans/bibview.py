"""A bibliography derived from the table `documents`, the same in Spark and in SQL: every tenth record is a subject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUTHORS = ("Adams, Ernest M.", "Adams, E. M.", "John Smith", "J. Smith", "Doe, Jane", "Williams, Alice", "Johnson, Robert")
PUBLISHERS = ("Academic Press", "Academic Presses", "Clarendon House")


def bib_view(spark: SparkSession, sf_dir: str, ascii_only: bool = False) -> DataFrame:
    """item_index, is_subject, title, author, author_surnames, year, doi, journal, volume, number, pages, publisher, bibkey."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    d, tens = F.col("doc_id"), F.expr("doc_id div 10")
    first = F.regexp_extract("text", r"^\s*+((?:\S++\s++){0,7}+\S*+)", 1)  # the rest of a text, of any length, is not cut into words
    t8 = F.array_join(F.split(F.regexp_replace(first, r"\s+$", ""), r"\s+"), " ")
    author = F.element_at(F.array(*map(F.lit, AUTHORS)), (d % 7 + 1).cast("int"))
    start = d % 7 * 10 + 1
    view = docs.select(
        d.alias("item_index"),
        (d % 10 == 5).alias("is_subject"),
        F.when(d % 13 == 0, F.concat(F.lit("Review of "), t8)).when(d % 19 == 0, F.concat(F.lit("Errata: "), t8)).otherwise(t8).alias("title"),
        author.alias("author"),
        F.array(F.when(author.contains(","), F.substring_index(author, ",", 1)).otherwise(F.substring_index(author, " ", -1))).alias("author_surnames"),
        F.when(d % 17 != 0, 1950 + d % 70).cast("int").alias("year"),
        F.when((d % 5 == 0) & (tens % 3 == 0), F.concat(F.lit("10.5555/"), tens.cast("string"))).alias("doi"),
        F.concat(F.lit("Journal "), F.expr("CAST((doc_id div 20) % 5 AS string)")).alias("journal"),
        (tens % 20).cast("string").alias("volume"),
        (tens % 4).cast("string").alias("number"),
        F.concat(start.cast("string"), F.lit("--"), (start + 9).cast("string")).alias("pages"),
        F.element_at(F.array(*map(F.lit, PUBLISHERS)), (d % 3 + 1).cast("int")).alias("publisher"),
        F.concat(F.lit("key:"), d.cast("string")).alias("bibkey"),
    )
    return view.where(F.col("title").rlike("^[ -~]+$")) if ascii_only else view


def subjects(view: DataFrame) -> DataFrame:
    return view.where("is_subject").withColumnRenamed("item_index", "subject_index")


def candidates(view: DataFrame) -> DataFrame:
    return view.where("NOT is_subject")


def listed(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


BIB_SQL = f"""
t AS (SELECT doc_id AS d, doc_id // 10 AS tens, array_to_string(list_slice(string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+'), 1, 8), ' ') AS t8 FROM documents),
bib_all AS (
  SELECT d AS item_index, d % 10 = 5 AS is_subject,
    CASE WHEN d % 13 = 0 THEN 'Review of ' || t8 WHEN d % 19 = 0 THEN 'Errata: ' || t8 ELSE t8 END AS title,
    {listed(AUTHORS)}[d % 7 + 1] AS author,
    CASE WHEN d % 17 <> 0 THEN CAST(1950 + d % 70 AS INTEGER) END AS year,
    CASE WHEN d % 5 = 0 AND tens % 3 = 0 THEN '10.5555/' || tens END AS doi,
    'Journal ' || ((d // 20) % 5) AS journal, CAST(tens % 20 AS VARCHAR) AS volume, CAST(tens % 4 AS VARCHAR) AS number,
    (d % 7 * 10 + 1) || '--' || (d % 7 * 10 + 10) AS pages,
    {listed(PUBLISHERS)}[d % 3 + 1] AS publisher, 'key:' || d AS bibkey
  FROM t),
bib_named AS (SELECT *, CASE WHEN contains(author, ',') THEN string_split(author, ',')[1] ELSE string_split(author, ' ')[-1] END AS family FROM bib_all)"""

ASCII_SQL = BIB_SQL + ", bib AS (SELECT * FROM bib_named WHERE regexp_full_match(title, '[ -~]+'))"
ALL_SQL = BIB_SQL + ", bib AS (SELECT * FROM bib_named)"
