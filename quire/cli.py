"""Command line: python -m quire.cli match | journal | urls | json. Run it with spark-submit on a cluster."""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scoring import Weights
from .functions.text import nonempty
from .operators import crossref, keys, matching, output, rawtext
from .sources import readers, sinks
from .store import materialize

log = logging.getLogger("quire")


def flat_records(rows: DataFrame, key: str) -> DataFrame:
    """Matching columns of rows in the bibliography's flat columns; authors are 'Family, Given' joined by 'and'."""
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("title", "author", "date", "doi", "journal", "volume", "number", "pages", "publisher") if c not in rows.columns})
    names = F.transform(F.split(F.coalesce("author", F.lit("")), r"\s+and\s+"), lambda a: F.trim(F.substring_index(a, ",", 1)))
    first_range = F.trim(F.substring_index("pages", ",", 1))
    return rows.select(
        F.col("row_id").alias(key), "bibkey", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("author", F.lit("")).alias("author"), F.filter(names, lambda n: n != "").alias("author_surnames"),
        F.regexp_extract(F.coalesce("date", F.lit("")), r"(\d{4})", 1).try_cast("int").alias("year"), *[nonempty(F.col(c)).alias(c) for c in ("doi", "journal", "volume", "number")], nonempty(first_range).alias("pages"), nonempty(F.col("publisher")).alias("publisher"),
    )


def match_files(spark: SparkSession, args: argparse.Namespace) -> None:
    weights = Weights.partly(title=args.title_weight, author=args.author_weight, date=args.date_weight, bonus=args.bonus_weight)
    if abs(weights.total() - 1) > 0.01:
        log.warning("weights sum to %s, not to 1", weights.total())
    inputs, bibliography = readers.read_staged(spark, args.input), readers.read_staged(spark, args.bibliography)
    subjects, items = flat_records(inputs, "subject_index"), flat_records(bibliography, "item_index")
    indexed = sinks.cached_index(items, args.cache, rebuild=args.force_rebuild) if args.cache else None
    texts = items.select("item_index", "bibkey", output.flat_citation().alias("full_entry"))
    began, n = time.perf_counter(), subjects.count()
    found = materialize(matching.match(subjects, items, weights, args.top_n, args.min_score, indexed=indexed), "matches")
    each = (time.perf_counter() - began) * 1000 // max(n, 1)
    sinks.write_csv(output.match_rows(inputs, found.join(texts, "item_index"), args.top_n, items.count(), search_time_ms=each), args.output)


def with_keys(spark: SparkSession, parsed: DataFrame, path: str | None, args: argparse.Namespace) -> DataFrame:
    if not path:
        return parsed
    index = keys.journal_index(readers.read_staged(spark, path), args.column_bibkey, args.column_journal, args.column_volume, args.column_number)
    flat = parsed.withColumns({c: F.col(f"out.{c}") for c in ("journal", "volume", "number", "bibkey")})
    named = keys.match_bibkey(flat, index, F.col("parsing_status"))
    return named.withColumn("out", F.when(F.col("out").isNotNull(), F.col("out").withField("bibkey", F.col("bibkey"))))


def journal(spark: SparkSession, args: argparse.Namespace) -> None:
    readers.register(spark)
    works = spark.read.format("works").options(base=args.base, issn=args.issn, until=str(args.until), **{"from": str(args.first)}).load()
    sinks.write_records(with_keys(spark, crossref.parse(works), args.index, args), args.output)


def json_files(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.write_records(with_keys(spark, rawtext.convert(rawtext.from_json_files(spark, args.input)), args.index, args), args.output)


def urls(spark: SparkSession, args: argparse.Namespace) -> None:
    """Saves the visible text of each page; records come of it by a model client, see sources.readers.ask_model."""
    from .operators import html

    sinks.write_csv(html.texts(readers.fetch(readers.read_urls(spark, args.input)).select("url", "html")).drop("html"), args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quire")
    sub = top.add_subparsers(dest="command", required=True)
    m = sub.add_parser("match")
    m.add_argument("--bibliography", required=True)
    m.add_argument("--top-n", type=int, default=5)
    m.add_argument("--min-score", type=float, default=0.0)
    for x in ("title", "author", "date", "bonus"):
        m.add_argument(f"--{x}-weight", type=float)
    m.add_argument("--cache")
    m.add_argument("--force-rebuild", action="store_true")
    j = sub.add_parser("journal")
    j.add_argument("--base", required=True)
    j.add_argument("--issn", required=True)
    j.add_argument("--first", type=int, required=True)
    j.add_argument("--until", type=int, required=True)
    for x in (m, sub.add_parser("json"), sub.add_parser("urls")):
        x.add_argument("--input", required=True)
    for x in sub.choices.values():
        x.add_argument("--output", required=True)
        x.add_argument("--index")
        for c in ("bibkey", "journal", "volume", "number"):
            x.add_argument(f"--column-{c}", default=c)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    {"match": match_files, "journal": journal, "json": json_files, "urls": urls}[args.command](spark, args)


if __name__ == "__main__":
    main()
