"""The scoring rules as SQL text, for comparison on another engine."""

from __future__ import annotations

from ..functions.scoring import DATE_POINTS, Weights
from ..functions.text import ACADEMIC_PREFIXES
from .bibview import ASCII_SQL


def normal(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"


def tokens_sorted(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def bare(x: str) -> str:
    return f"regexp_replace({x}, '\\.+$', '')"


FEATURES_SQL = f"""
f0 AS (
  SELECT *, {normal('title')} AS tn, {normal('author')} AS an, lower(author) AS al, {normal('journal')} AS jn, {normal('publisher')} AS pn,
    regexp_matches(ltrim(lower(title)), '^({"|".join(ACADEMIC_PREFIXES)})') AS prefixed,
    string_split(trim(regexp_replace(author, '\\s+', ' ', 'g')), ' ') AS parts, (year // 10) * 10 AS decade,
    CASE WHEN length(title) >= 3 THEN list_distinct(list_transform(range(1, length(title) - 1), lambda i: substring(lower(title), i, 3))) ELSE [] END AS grams
  FROM bib),
feat AS (
  SELECT *, {tokens_sorted('tn')} AS ts, {tokens_sorted('an')} AS au, {tokens_sorted('pn')} AS ps, parts[-1] AS surname, lower(parts[-1]) AS sl,
    upper(substring({bare('parts[-1]')}, 1, 1)) AS si,
    list_transform(list_slice(parts, 1, len(parts) - 1), lambda x: upper(substring({bare('x')}, 1, 1))) AS gi,
    len(list_filter(list_slice(parts, 1, len(parts) - 1), lambda x: strlen({bare('x')}) = 1 AND regexp_matches({bare('x')}, '[A-Za-z]'))) AS ni
  FROM f0),
subj AS (SELECT * FROM feat WHERE is_subject), cand AS (SELECT * FROM feat WHERE NOT is_subject)"""


def jw(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE jaro_winkler_similarity({a}, {b}) * 100.0 END"


def apart(word: str) -> str:
    return f"CASE WHEN contains(s_tn, '{word}') <> contains(c_tn, '{word}') THEN 1 ELSE 0 END"


DATE_SQL = "CASE WHEN s_year IS NULL OR c_year IS NULL THEN 0.0 " + " ".join(f"WHEN abs(s_year - c_year) = {y} THEN {p}" for y, p in DATE_POINTS) + " WHEN s_decade = c_decade THEN 40.0 ELSE 0.0 END"

#: Pairs `pairs` (subject_index, item_index) to unweighted points `points`.
POINTS_SQL = f"""
raw AS (
  SELECT p.subject_index, p.item_index, p.sure, s.prefixed <> c.prefixed AS gated, s.tn AS s_tn, c.tn AS c_tn, s.year AS s_year, c.year AS c_year, s.decade AS s_decade, c.decade AS c_decade,
    {jw('s.ts', 'c.ts')} AS rt, {jw('s.au', 'c.au')} AS ra, {jw('s.sl', 'c.sl')} AS rs, {jw('s.ps', 'c.ps')} AS rp,
    s.si = c.si AS same_initial, s.ni AS s_ni, c.ni AS c_ni, least(len(s.gi), len(c.gi)) AS shorter,
    len(list_filter(range(1, least(len(s.gi), len(c.gi)) + 1), lambda i: s.gi[i] = c.gi[i])) AS agreeing,
    coalesce(s.doi <> '' AND s.doi = c.doi, false) AS same_doi, s.jn <> '' AND s.jn = c.jn AND s.volume = c.volume AND s.number = c.number AS same_place, s.pages = c.pages AS same_pages
  FROM pairs p JOIN subj s ON s.item_index = p.subject_index JOIN cand c ON c.item_index = p.item_index),
points AS (
  SELECT subject_index, item_index, sure,
    CASE WHEN gated THEN 0.0 ELSE greatest(0.0, rt + CASE WHEN (rt > 85.0 OR contains(s_tn, c_tn) OR contains(c_tn, s_tn)) AND {apart('errata')} + {apart('review')} = 0 THEN 100.0 ELSE 0.0 END - 50.0 * ({apart('errata')} + {apart('review')})) END AS title_points,
    CASE WHEN gated THEN 0.0 ELSE ra + CASE WHEN ra > 85.0 THEN 100.0 WHEN same_initial AND rs >= 80.0 AND s_ni <> c_ni AND agreeing > 0 AND agreeing >= shorter - 1 THEN 50.0 ELSE 0.0 END END AS author_points,
    CASE WHEN gated THEN 0.0 ELSE {DATE_SQL} END AS date_points,
    CASE WHEN gated THEN 0.0 ELSE CASE WHEN same_doi THEN 100.0 ELSE 0.0 END + CASE WHEN same_place THEN 50.0 ELSE 0.0 END + CASE WHEN same_pages THEN 20.0 ELSE 0.0 END + CASE WHEN rp > 85.0 THEN 10.0 ELSE 0.0 END END AS bonus_points
  FROM raw)"""

#: Subjects with an indexed DOI get the last item that has it.
SURE_SQL = """
sure AS (SELECT s.item_index AS subject_index, max(c.item_index) AS item_index, true AS sure FROM subj s JOIN cand c ON s.doi = c.doi WHERE s.doi <> '' GROUP BY 1),
open AS (SELECT * FROM subj WHERE item_index NOT IN (SELECT subject_index FROM sure))"""

TRIGRAM, SURNAME, DECADE = "list_has_any(s.grams, c.grams)", "(s.al <> '' AND c.family <> '' AND contains(s.al, lower(c.family)))", "coalesce(abs(s.decade - c.decade) <= 50, false)"

BLOCKED_SQL = f"""
near AS (SELECT s.item_index AS subject_index, c.item_index, false AS sure FROM open s JOIN cand c ON {TRIGRAM} OR {SURNAME} OR {DECADE}),
pairs AS (SELECT * FROM near UNION ALL SELECT s.item_index, c.item_index, false FROM open s, cand c WHERE s.item_index NOT IN (SELECT subject_index FROM near) UNION ALL SELECT * FROM sure)"""

ALL_PAIRS_SQL = "pairs AS (SELECT s.item_index AS subject_index, c.item_index, false AS sure FROM open s, cand c UNION ALL SELECT * FROM sure)"


def scored(pairs: str = BLOCKED_SQL, weights: Weights = Weights()) -> str:
    w = dict(zip(("title", "author", "date", "bonus"), weights.to_tuple()))
    parts = ", ".join(f"{k}_points * CAST({v} AS DOUBLE) AS {k}_score" for k, v in w.items())
    return f"WITH {ASCII_SQL}, {FEATURES_SQL}, {SURE_SQL}, {pairs}, {POINTS_SQL}, scored AS (SELECT *, title_score + author_score + date_score + bonus_score AS total_score FROM (SELECT *, {parts} FROM points))"


def ranked(top_n: int = 5, **options) -> str:
    return scored(**options) + f", ranked AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY subject_index ORDER BY total_score DESC, item_index) AS INTEGER) AS rank FROM scored) WHERE rank <= {top_n})"
