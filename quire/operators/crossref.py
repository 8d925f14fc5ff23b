"""API records of works, as JSON text, to bibliographic records with a parsing status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty
from ..sources.schemas import BIB_ITEM, CROSSREF

#: Fields that must be text if they are there.
TEXTS = ("publisher", "issue", "DOI", "type", "page", "source", "prefix", "volume", "language", "URL")
#: Fields that must be lists if they are there.
LISTS = ("title", "author", "container-title", "short-container-title", "link", "alternative-id", "ISSN", "issn-type")


def not_text(variant: Column, name: str) -> Column:
    """Whether a top-level field is something other than text, which a lenient reader would turn into text."""
    kind = F.schema_of_variant(F.try_variant_get(variant, f"$['{name}']", "variant"))
    return F.coalesce(~kind.isin("STRING"), F.lit(False))


def not_list(variant: Column, name: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(variant, f"$['{name}']", "variant"))
    return F.coalesce(~kind.startswith("ARRAY"), F.lit(False))


def parse(raw: DataFrame, column: str = "raw", needs_journal: bool = True) -> DataFrame:
    """raw with parsing_status, message, context and `out`, a bibliographic record, null on error.

    The year is the first part of the issue date; the first container title is the journal; pages split at the first
    hyphen. Broken JSON, a number where text belongs, text where a list belongs and a null part of a date are errors; so is
    a work without a container title, if needs_journal.
    """
    text = F.col(column)
    works = raw.withColumn("_work", F.from_json(text, CROSSREF, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    works = works.withColumn("_json", F.try_parse_json(text))  # once for all fields
    w = lambda name: F.col(f"_work.`{name}`")
    json = F.col("_json")
    kinds = F.array(*[F.when(not_text(json, c), c) for c in TEXTS], *[F.when(not_list(json, c), c) for c in LISTS])
    parts = [F.col(f"_work.`{c}`.`date-parts`") for c in ("issued", "published", "published-print", "published-online", "created", "deposited", "indexed")]
    null_part = [F.coalesce(F.exists(p, lambda day: day.isNull() | F.exists(day, lambda x: x.isNull())), F.lit(False)) for p in parts]
    journal = nonempty(F.get(w("container-title"), 0))
    problem = F.coalesce(
        F.when(text.isNull(), "no response"),
        F.when(F.col("_work").isNull() | w("_corrupt").isNotNull() | json.isNull(), "not valid JSON for a work"),
        F.concat(F.lit("wrong type: "), nonempty(F.array_join(F.array_compact(kinds), ", "))),
        F.when(F.greatest(*null_part, F.lit(False)), "null in date parts"),
        F.when(F.lit(needs_journal) & journal.isNull(), "no container title"),
    )
    year = F.get(F.get(F.col("_work.issued.`date-parts`"), 0), 0)
    page = nonempty(w("page"))
    ends = F.split(page, "-", 2)
    empty = lambda c: F.coalesce(c, F.lit(""))
    record = F.struct(
        F.lit(None).cast("string").alias("entry_type"), F.lit(None).cast("string").alias("bibkey"),
        F.coalesce(F.transform(w("author"), lambda a: F.struct(empty(a["given"]).alias("given"), empty(a["family"]).alias("family"))), F.array()).alias("author"),
        empty(F.array_join(w("title"), " ")).alias("title"), F.when(year != 0, year).alias("year"), F.lit("").alias("pubstate"), journal.alias("journal"),
        empty(F.get(w("ISSN"), 0)).alias("issn_print"), empty(F.get(w("ISSN"), 1)).alias("issn_electronic"), empty(w("volume")).alias("volume"), empty(w("issue")).alias("number"),
        F.when(page.isNull(), F.array()).otherwise(F.array(F.struct(F.get(ends, 0).alias("start"), empty(F.get(ends, 1)).alias("end")))).alias("pages"),
        empty(w("publisher")).alias("publisher"), empty(w("DOI")).alias("doi"), empty(w("URL")).alias("url"), F.lit("Crossref").alias("source"),
    ).cast(BIB_ITEM)
    return status(works.withColumn("_problem", problem), record, text).drop("_work")


def status(rows: DataFrame, record: Column, context: Column) -> DataFrame:
    """parsing_status, message, context and out from a column _problem that is null for good rows."""
    good = F.col("_problem").isNull()
    return rows.withColumns(
        {"parsing_status": F.when(good, "success").otherwise("error"), "message": F.coalesce("_problem", F.lit("")), "context": F.when(good, "").otherwise(F.coalesce(context, F.lit(""))), "out": F.when(good, record)}
    ).drop("_problem")


def successes(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parsing_status") == "success")


def items_of_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row `raw` for each item of list responses, in their JSON text."""
    items = F.from_json(F.get_json_object(column, "$.message.items"), "array<variant>")
    return responses.select(F.explode(items).alias("v")).select(F.to_json("v").alias("raw"))


def pages_of_years(issn: str, first: int, last: int, spark) -> DataFrame:
    """issn, year for each year of the range, ends included; none if it is empty."""
    return spark.range(first, last + 1).select(F.lit(issn).alias("issn"), F.col("id").cast("int").alias("year"))
