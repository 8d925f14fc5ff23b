"""Text functions on columns; blanks are Unicode's unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"(?U)\s+"


def squeeze(s: Column) -> Column:
    """Blanks collapsed to one space, ends trimmed."""
    return F.trim(F.regexp_replace(s, BLANKS, " "))


def normalize(s: Column) -> Column:
    return squeeze(F.lower(s))


def sorted_tokens(normal: Column) -> Column:
    """Tokens of a normalised string in byte order, joined by a space."""
    return F.array_join(F.array_sort(F.split(normal, " ")), " ")


def grams(s: Column) -> Column:
    def of(t: Column) -> Column:  # a variable of a lambda: the string is worked out once, and not for each of its positions
        some = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), lambda i: F.substring(t, i, F.lit(3))))
        return F.when(F.length(t) >= 3, some).when(t.isNotNull(), F.array().cast("array<string>"))

    return F.transform(F.array(s), of)[0]


def trigrams(text: Column) -> Column:
    """Distinct 3-grams of the lower-cased text as it stands; none for fewer than three characters."""
    return grams(F.lower(text))


def trigrams_squeezed(text: Column) -> Column:
    """The variant that collapses blanks first."""
    return grams(normalize(text))


def decade(year: Column) -> Column:
    """Truncates towards zero."""
    return (year - year % 10).cast("int")


def decade_floor(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def surnames(families: Column) -> Column:
    """Distinct normalised family names, blank ones left out."""
    return F.array_distinct(F.filter(F.transform(families, normalize), lambda x: x != ""))


def nonempty(s: Column) -> Column:
    """Null for null and for the empty string."""
    return F.nullif(s, F.lit(""))


#: Fixed list of prefixes that mark a review or a reply.
ACADEMIC_PREFIXES = ("reply to", "comments on", "précis of", "precis of", "review of", "critical notice", "symposium on", "discussion of", "response to", "a reply to", "responses to")


def has_academic_prefix(title: Column) -> Column:
    return F.regexp_replace(F.lower(title), r"(?U)^\s+", "").rlike("^(?:" + "|".join(ACADEMIC_PREFIXES) + ")")


def keywords_differ(a: Column, b: Column, *keywords: str) -> Column:
    """How many keywords are in exactly one of two strings."""
    return sum((F.when(a.contains(k) != b.contains(k), 1).otherwise(0) for k in keywords), F.lit(0))
