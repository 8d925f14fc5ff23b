"""The two comparator variants beside the canonical scorer: whole-number scores, without prefix gate, initials bonus or clamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import HIGH, Weights, date_points, equal
from ..functions.similarity import fuzzy_ratio
from ..functions.text import keywords_differ, nonempty, normalize


def similarity_points(a: Column, b: Column, penal: bool = False) -> Column:
    """Ratio, 100 more when it is high and no keyword differs; 50 less for each differing keyword. May be negative."""
    raw, off = fuzzy_ratio(a, b), keywords_differ(normalize(a), normalize(b), "errata", "review") if penal else F.lit(0)
    held = normalize(a).contains(normalize(b)) | normalize(b).contains(normalize(a)) if penal else F.lit(False)
    return (raw + F.when(((raw > HIGH) | held) & (off == 0), 100).otherwise(0) - 50 * off).cast("int")


def bonus(s: str, c: str) -> Column:
    """100 for the DOI, 50 for journal, volume and number, 20 for the first pages of all ranges, 10 for the publisher."""
    g = lambda side, name: F.col(f"{side}.{name}")
    place = equal(normalize(g(s, "journal")), normalize(g(c, "journal"))) & equal(g(s, "volume"), g(c, "volume")) & equal(g(s, "number"), g(c, "number"))
    starts = lambda side: nonempty(F.substring_index(g(side, "pages"), "--", 1))
    points = F.when(equal(g(s, "doi"), g(c, "doi")), 100).otherwise(0) + F.when(place, 50).otherwise(0) + F.when(F.coalesce(starts(s) == starts(c), F.lit(False)), 20).otherwise(0)
    return (points + F.when(F.coalesce(fuzzy_ratio(nonempty(g(s, "publisher")), nonempty(g(c, "publisher"))), F.lit(0)) > HIGH, 10).otherwise(0)).cast("int")


def compare_legacy(pairs: DataFrame) -> DataFrame:
    """Adds title, author, year and total scores to pairs of structs s and c; an empty title or author on either side is an error row."""
    blank = lambda name: nonempty(F.col(f"s.{name}")).isNull() | nonempty(F.col(f"c.{name}")).isNull()
    fault = F.when(blank("title"), "empty title").when(blank("author"), "empty author")
    near = F.when(F.abs(F.col("s.year") - F.col("c.year")) <= 1, 100).otherwise(0)
    scored = pairs.withColumn("message", F.coalesce(fault, F.lit(""))).withColumn("parsing_status", F.when(fault.isNull(), "success").otherwise("error"))
    parts = {"title_score": similarity_points(F.col("s.title"), F.col("c.title"), True), "author_score": similarity_points(F.col("s.author"), F.col("c.author")), "year_score": near}
    scored = scored.withColumns({k: F.when(F.col("parsing_status") == "success", v) for k, v in parts.items()})
    return scored.withColumn("total_score", F.col("title_score") + F.col("author_score") + F.col("year_score"))


def compare_detailed(pairs: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Adds partial_scores (component, score, weight, weighted_score, details) and total_score to pairs of structs s and c."""
    s, c = F.col("s"), F.col("c")
    there = lambda name: nonempty(s[name]).isNotNull() & nonempty(c[name]).isNotNull()
    title = F.when(there("title"), similarity_points(s["title"], c["title"], True)).otherwise(0)
    author = F.when(there("author"), similarity_points(s["author"], c["author"])).otherwise(0)
    years = F.concat_ws("; ", F.when(s["year"].isNull() | c["year"].isNull(), "year missing"), F.when(s["year"] == c["year"], "same year"), F.concat(F.abs(s["year"] - c["year"]).cast("string"), F.lit(" years apart")))
    rows = (
        ("title", title, weights.title, F.concat(F.lit("title points "), title.cast("string"))), ("author", author, weights.author, F.concat(F.lit("author points "), author.cast("string"))),
        ("date", date_points(s["year"], c["year"]).cast("int"), weights.date, years), ("publisher", bonus("s", "c"), weights.bonus, F.lit("bonus fields")),
    )
    parts = [F.struct(F.lit(n).alias("component"), x.cast("int").alias("score"), F.lit(float(w)).alias("weight"), (x * F.lit(float(w))).alias("weighted_score"), d.alias("details")) for n, x, w, d in rows]
    out = pairs.withColumn("partial_scores", F.array(*parts))
    return out.withColumn("total_score", F.aggregate("partial_scores", F.lit(0.0), lambda a, p: a + p["weighted_score"]))
