import numpy as np
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import scoring, similarity, text
from quire.operators.quality import grid


def plain_jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, matched = [True] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == x:
                free[j] = False
                matched.append(x)
                break
    m = len(matched)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(matched, (y for j, y in enumerate(b) if not free[j]))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    lead = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        lead += 1
    return jaro + 0.1 * lead * (1 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler_vectors():
    got = similarity.jaro_winkler_pairs(["martha", "dixon", "abcdef", "a", ""], ["marhta", "dicksonx", "abcdeg", "b", ""])
    assert got == pytest.approx([0.9611111, 0.8133333, 0.9333333, 0, 1], abs=1e-6)


def test_jaro_winkler_is_the_plain_rule():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abé ñc") for _ in range(rng.randint(0, 14)))
    left, right = [word() for _ in range(3000)], [word() for _ in range(3000)]
    assert list(similarity.jaro_winkler_pairs(left, right)) == pytest.approx([plain_jaro_winkler(a, b) for a, b in zip(left, right)], abs=1e-12)


def one(spark, *columns, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(*columns).first()


@pytest.mark.parametrize(("a", "b", "low", "high"), [("hello world", "world hello", 100, 100), ("hello world", "goodbye moon", 0, 50), ("", "hello", 0, 0), ("Hello  World", "hello world", 100, 100)])
def test_token_sort_ratio(spark, a, b, low, high):
    got = one(spark, similarity.token_sort_ratio(F.col("a"), F.col("b")), a=a, b=b)[0]
    assert low <= got <= high


@pytest.mark.parametrize(("s", "grams"), [("hello", ["hel", "ell", "llo"]), ("hi", []), ("", []), ("AAAA", ["aaa"])])
def test_trigrams(spark, s, grams):
    assert one(spark, text.trigrams(F.col("s")), s=s)[0] == grams


@pytest.mark.parametrize(("y", "d"), [(1995, 1990), (2000, 2000), (2025, 2020), (-15, -10)])
def test_decade(spark, y, d):
    assert one(spark, text.decade(F.col("y")), y=y)[0] == d


@pytest.mark.parametrize(("year", "points"), [(2020, 100), (2021, 95), (2022, 90), (2023, 85), (2024, 75), (2025, 65), (2028, 40), (2031, 0)])
def test_date_points(spark, year, points):
    assert one(spark, scoring.date_points(F.lit(2020), F.col("y")), y=year)[0] == points


@pytest.mark.parametrize(("title", "marked"), [("Reply to Smith on Knowledge", True), ("  Précis of X", True), ("On the Nature of Knowledge", False)])
def test_academic_prefix(spark, title, marked):
    assert one(spark, text.has_academic_prefix(F.col("t")), t=title)[0] is marked


@pytest.mark.parametrize(("name", "initial"), [("E.", True), ("E", True), ("Ernest", False), ("", False), ("É.", False)])
def test_initial(spark, name, initial):
    assert one(spark, scoring.is_initial(F.col("n")), n=name)[0] is initial


ROW = {"title": "t", "author_surnames": ["x"], "year": 2000, "doi": None, "journal": None, "volume": None, "number": None, "pages": None, "publisher": None}


@pytest.mark.parametrize(
    ("a", "b", "match"),
    [("E. M. Adams", "Ernest M. Adams", True), ("J. Smith", "John Smith", True), ("E. Adams", "Ernest Jones", False), ("Ernest Adams", "Ernest Adams", False), ("E. Adams", "E. Adams", False)],
)
def test_initials_match(spark, a, b, match):
    schema = "author string, title string, author_surnames array<string>, year int, doi string, journal string, volume string, number string, pages string, publisher string"
    rows = spark.createDataFrame([(x, *ROW.values()) for x in (a, b)], schema)
    s, c = (scoring.features(rows.where(F.col("author") == x)).limit(1).select(F.struct(*scoring.FEATURES).alias(n)) for x, n in ((a, "s"), (b, "c")))
    pair = s.crossJoin(c)
    ratio = similarity.ratio_of_sorted(F.col("s.surname_sorted"), F.col("c.surname_sorted"))
    assert bool(pair.select(scoring.initials_match(F.col("s"), F.col("c"), ratio)).first()[0]) is match


def test_grid_and_weights():
    assert len(grid()) == 110
    assert scoring.Weights().to_tuple() == (0.25, 0.25, 0.2, 0.3)
    assert scoring.Weights.partly(title=0.7).to_tuple() == (0.7, 0.3, 0.1, 0.1)
    assert scoring.Weights.partly(title=None) == scoring.Weights()


def test_jaro_winkler_by_bits_is_that_by_places():
    rng = np.random.default_rng(1)
    letters = list("abcdefgh é日")
    left, right = (["".join(rng.choice(letters, rng.integers(0, 80))) for _ in range(600)] for _ in range(2))
    left[:100] = right[:100]
    every = similarity.jaro_winkler_pairs(left, right)
    one = [similarity.compared(similarity.codes([a], -1), similarity.codes([b], -2))[0] for a, b in zip(left, right)]
    assert np.array_equal(every, np.array(one))
