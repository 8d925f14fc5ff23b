"""Schemas of the records that sources give."""

from __future__ import annotations

PERSON = "struct<given: string, family: string>"
#: The record that every extractor gives.
RAW_TEXT = f"raw_text string, type string, title string, year int, pubstate string, authors array<{PERSON}>, editors array<{PERSON}>, journal string, volume string, issue_number string, start_page string, end_page string, publisher string, doi string, url string"
#: The bibliographic record that converters give.
BIB_ITEM = f"""struct<entry_type: string, bibkey: string, author: array<{PERSON}>, title: string, year: int, pubstate: string, journal: string, issn_print: string, issn_electronic: string,
volume: string, number: string, pages: array<struct<start: string, end: string>>, publisher: string, doi: string, url: string, source: string>"""
DATES = "struct<`date-parts`: array<array<int>>>"
STAMP = "struct<`date-parts`: array<array<int>>, `date-time`: string, timestamp: bigint>"
CROSSREF = f"""indexed {STAMP}, publisher string, issue string, `short-container-title` array<string>, `published-print` {DATES}, DOI string, type string, created {STAMP}, page string, source string,
title array<string>, prefix string, volume string, author array<struct<given: string, family: string, sequence: string, affiliation: array<map<string, string>>>>, `published-online` {DATES}, `container-title` array<string>, language string,
link array<struct<URL: string, `content-type`: string, `content-version`: string, `intended-application`: string>>, deposited {STAMP}, issued {DATES}, `references-count` int, `alternative-id` array<string>, URL string, ISSN array<string>,
`issn-type` array<struct<value: string, type: string>>, published {DATES}, _corrupt string"""
