"""BibTeX entries to raw-text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nonempty

#: Fixed names of entry types that stand for others.
TYPES = {"inbook": "incollection", "conference": "inproceedings"}
DASHES = "[-–—]"


def entries(files: DataFrame, column: str = "value") -> DataFrame:
    """entry and its place: the text is split before each '@' that begins a line."""
    return files.select("*", F.posexplode(F.split(column, "\n@")).alias("place", "_e")).withColumn("entry", F.when(F.trim("_e").startswith("@"), F.trim("_e")).otherwise(F.concat(F.lit("@"), F.col("_e")))).drop("_e")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return entries(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")).drop("value")


def first(s: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null if there is none."""
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, group))


def field(entry: Column, name: str, balanced: bool = False) -> Column:
    """A field's value up to the first closing brace or quote; balanced: whole words as names, and braces to a depth of three."""
    if balanced:
        inner = r"[^{}]*"
        for _ in range(2):
            inner = rf"(?:[^{{}}]|\{{{inner}\}})*"
        return F.trim(first(entry, rf'(?is)\b{name}\s*=\s*(?:\{{({inner})\}}|"[^"]*")'))
    return F.regexp_replace(first(entry, rf'(?is){name}\s*=\s*[{{"]([^}}"]*)[}}"]'), r"(?U)^\s+|\s+$", "")


def clean_tex(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(s, "{}", ""), r"(?U)\s+", " "))


def split_name(part: Column) -> Column:
    """struct<given,family> of 'Family, Given' or of 'Given Family'."""
    part = F.trim(part)
    given, family = F.trim(F.regexp_extract(part, r"(?s)^[^,]*,(.*)$", 1)), F.trim(F.substring_index(part, ",", 1))
    last = F.regexp_extract(part, r"(?Us)(\S+)\s*$", 1)
    lead = F.trim(F.regexp_extract(part, r"(?Us)^(.*?)\s*\S+\s*$", 1))
    return F.when(part.contains(","), F.struct(given.alias("given"), family.alias("family"))).otherwise(F.struct(lead.alias("given"), last.alias("family")))


def people(s: Column, joint: str = r"(?iU)\s+and\s+", strip: str | None = None) -> Column:
    """array<struct<given,family>>, null if there is nobody."""
    parts = F.transform(F.split(s, joint), F.trim)
    if strip:
        parts = F.transform(parts, lambda p: F.regexp_replace(p, strip, ""))
    named = F.transform(F.filter(parts, lambda p: p != ""), split_name)
    clean = F.transform(named, lambda p: F.struct(clean_tex(p["given"]).alias("given"), clean_tex(p["family"]).alias("family")))
    return F.when(F.size(clean) > 0, clean)


def year_of(value: Column) -> Column:
    digits = F.when(value.rlike(r"^\d+$"), value).when(~F.lower(value).isin("forthcoming", "in press", "inpress", "no date", "n.d."), first(value, r"(?U)\b(\d{4})\b"))
    return digits.try_cast("int")


def parse(rows: DataFrame, column: str = "entry", balanced: bool = False) -> DataFrame:
    """Raw-text records of entries; entries without a type or a title give none."""
    e = F.col(column)
    get = lambda name: field(e, name, balanced)
    kind = F.lower(first(e, r"^@(\w+)\{"))
    mapped = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair]), kind), kind)
    year, pages = get("year"), get("pages")
    span = rf"^(\d+)\s*{DASHES}+\s*(\d+)"
    return (
        rows.select(
            F.trim(e).alias("raw_text"), mapped.alias("type"), nonempty(clean_tex(get("title"))).alias("title"), year_of(year).alias("year"),
            F.when(F.lower(year).isin("forthcoming", "in press", "inpress"), "forthcoming").alias("pubstate"), people(get("author")).alias("authors"), people(get("editor")).alias("editors"),
            nonempty(clean_tex(get("journal"))).alias("journal"), get("volume").alias("volume"), get("number").alias("issue_number"),
            F.coalesce(first(pages, span), F.when(pages.rlike(r"^\d+$"), pages)).alias("start_page"), first(pages, span, 2).alias("end_page"), nonempty(clean_tex(get("publisher"))).alias("publisher"),
            get("doi").alias("doi"), get("url").alias("url"),
        )
        .where(F.col("type").isNotNull() & F.col("title").isNotNull())
    )
