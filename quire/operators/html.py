"""Web pages: visible text, links, record metadata and catalogue items, by the standard library's parser.

Spark's XPath functions need well-formed markup, which pages aren't; the parser runs once for a page in an Arrow batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import nonempty
from .bibtex import first, people

HIDDEN = ("script", "style")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class Page(HTMLParser):
    """Text pieces outside hidden elements, links, meta tags, JSON-LD blocks, and list items of the wanted class."""

    def __init__(self, item_class: str = "element-list") -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.links: list[str] = []
        self.meta: dict[str, list[str]] = {}
        self.linked_data: list[str] = []
        self.items: list[dict] = []
        self.item_class, self.hidden, self.path, self.item = item_class, None, [], None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if self.hidden:
            return
        if tag in HIDDEN:
            self.hidden = (tag, a.get("type") == "application/ld+json")
        elif tag == "a" and a.get("href"):
            self.links.append(a["href"])
        elif tag == "meta" and (name := a.get("name") or a.get("property")):
            self.meta.setdefault(name, []).append(a.get("content", ""))
        if tag not in VOID:
            self.path.append((tag, a.get("class", "").split()))
        if tag == "li" and self.item_class in a.get("class", "").split():
            self.item = {"id": a.get("id", ""), "title": "", "description": "", "terms": [], "values": [], "depth": len(self.path)}

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag == self.hidden[0]:
                self.hidden = None
            return
        names = [t for t, _ in self.path]
        if tag in names:
            at = len(names) - 1 - names[::-1].index(tag)
            del self.path[at:]
        if self.item and len(self.path) < self.item["depth"]:
            self.items.append(self.item)
            self.item = None

    def handle_data(self, data: str) -> None:
        if self.hidden:
            if self.hidden[1]:
                self.linked_data.append(data)
            return
        self.texts.append(data)
        if self.item and self.path and (text := " ".join(data.split())):
            tag, classes = self.path[-1]
            if tag in ("dt", "dd"):
                self.item["terms" if tag == "dt" else "values"].append(text)
            elif any(t in ("h2", "h3") for t, _ in self.path[self.item["depth"] :]):
                self.item["title"] = f"{self.item['title']} {text}".strip()
            elif "description" in classes:
                self.item["description"] = f"{self.item['description']} {text}".strip()

    @classmethod
    def read(cls, html: str) -> Page:
        page = cls()
        page.feed(html)
        page.close()
        if page.item:
            page.items.append(page.item)
        return page


def by_page(kind: T.DataType, f: Callable[[Page], object]) -> Callable[[Column], Column]:
    @F.arrow_udf(kind)
    def run(html: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array([None if x is None else f(Page.read(x)) for x in html.to_pylist()], to_arrow_type(kind))

    return run


def visible(page: Page) -> str | None:
    lines = (line.strip() for text in page.texts for line in text.splitlines())
    return "\n".join(x for x in lines if x) or None


page_text = by_page(T.StringType(), visible)
page_links = by_page(T.ArrayType(T.StringType()), lambda page: list(dict.fromkeys(page.links)))


def loaded(page: Page) -> dict:
    for block in page.linked_data:
        try:
            data = json.loads(block)
        except ValueError:
            continue
        for x in data if isinstance(data, list) else data.get("@graph", [data]) if isinstance(data, dict) else []:
            if isinstance(x, dict) and x.get("name"):
                return x
    return {}


def metadata(page: Page) -> dict:
    """Structured data first for title, authors and date; citation tags for these otherwise, and for the rest alone."""
    data, one = loaded(page), lambda name: next(iter(page.meta.get(name, [])), None)
    creators = data.get("creator") or data.get("author") or []
    names = [x.get("name", "") if isinstance(x, dict) else str(x) for x in (creators if isinstance(creators, list) else [creators])]
    return {
        "title": data.get("name") or one("citation_title"), "names": [x for x in names if x] or page.meta.get("citation_author", []), "date": str(data.get("datePublished") or one("citation_publication_date") or one("citation_date") or "") or None,
        "doi": one("citation_doi"), "journal": one("citation_journal_title"), "volume": one("citation_volume"), "issue": one("citation_issue"), "start_page": one("citation_firstpage"), "end_page": one("citation_lastpage"),
        "publisher": one("citation_publisher"), "raw_text": (visible(page) or "")[:1000],
    }


TEXTS = ("title", "date", "doi", "journal", "volume", "issue", "start_page", "end_page", "publisher", "raw_text")
page_metadata = by_page(T.StructType([*(T.StructField(c, T.StringType()) for c in TEXTS), T.StructField("names", T.ArrayType(T.StringType()))]), metadata)
ITEM = T.StructType([*(T.StructField(c, T.StringType()) for c in ("id", "title", "description")), *(T.StructField(c, T.ArrayType(T.StringType())) for c in ("terms", "values"))])
page_items = by_page(T.ArrayType(ITEM), lambda page: [{k: v for k, v in item.items() if k != "depth"} for item in page.items])


def texts(pages: DataFrame) -> DataFrame:
    """pages with text, parsing_status and message; a page without visible text is an error."""
    found = pages.withColumn("text", page_text("html"))
    return found.withColumns({"parsing_status": F.when(F.col("text").isNull(), "error").otherwise("success"), "message": F.when(F.col("text").isNull(), "no text content").otherwise("")})


def links(pages: DataFrame, pattern: str = ".") -> DataFrame:
    """place and link of each page's distinct links that the pattern is found in, in the order of first sight."""
    return pages.select(*[c for c in pages.columns if c != "html"], F.posexplode(F.filter(page_links("html"), lambda x: x.rlike(pattern))).alias("place", "link"))


def records(pages: DataFrame) -> DataFrame:
    """Raw-text records of the pages' metadata."""
    m = pages.select(*[c for c in pages.columns if c != "html"], page_metadata("html").alias("m"))
    authors = F.flatten(F.transform("m.names", lambda n: F.coalesce(people(n, r"(?!)"), F.array())))
    keep = [c for c in pages.columns if c not in ("html", "url")]
    return m.where(nonempty(F.col("m.title")).isNotNull()).select(
        *keep, F.col("m.raw_text").alias("raw_text"), F.when(F.col("m.journal").isNotNull(), "article").otherwise("UNKNOWN").alias("type"), F.col("m.title").alias("title"), first(F.col("m.date"), r"(\d{4})").cast("int").alias("year"),
        F.lit(None).cast("string").alias("pubstate"), F.when(F.size(authors) > 0, authors).alias("authors"), F.lit(None).cast("array<struct<given:string,family:string>>").alias("editors"), F.col("m.journal").alias("journal"), F.col("m.volume").alias("volume"),
        F.col("m.issue").alias("issue_number"), F.col("m.start_page").alias("start_page"), F.col("m.end_page").alias("end_page"), F.col("m.publisher").alias("publisher"), F.regexp_replace("m.doi", r"^https?://doi\.org/", "").alias("doi"), (F.col("url") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
    )


def total_count(html: Column) -> Column:
    """The number that a result page names in a span."""
    return first(html, r"(?is)<span[^>]*>\s*[^<\d]*(\d+)[^<]*</span>").cast("int")


def catalogue(pages: DataFrame) -> DataFrame:
    """Raw-text records of a catalogue's list items: 'title / author', 'place : publisher, year' and labelled values."""
    item = pages.select(F.explode(page_items("html")).alias("i")).select("i.*")
    labelled = F.map_from_entries(F.transform(F.arrays_zip(F.slice("terms", 1, F.least(F.size("terms"), F.size("values"))).alias("k"), F.slice("values", 1, F.least(F.size("terms"), F.size("values"))).alias("v")), lambda p: F.struct(F.lower(F.rtrim(p["k"], F.lit(": "))).alias("k"), p["v"].alias("v"))))
    everything = F.concat_ws(" ", F.col("description"), F.array_join("values", " "))
    person = people(F.coalesce(nonempty(F.trim(F.regexp_extract("title", r" / (.*)$", 1))), F.element_at("values", 1)), r"(?!)")
    after = F.trim(F.regexp_replace(F.regexp_extract(F.coalesce("description", F.lit("")), r":\s*(.*)$", 1), r",?\s*\d{4}\s*$", ""))
    return item.withColumn("labels", F.when(F.size(F.array_distinct("terms")) == F.size("terms"), labelled)).select(
        "id", F.concat_ws(" ", "title", everything).alias("raw_text"), F.lit("mastersthesis").alias("type"), F.trim(F.substring_index("title", " / ", 1)).alias("title"), first(everything, r"\b((?:19|20)\d{2})\b").cast("int").alias("year"),
        F.when(F.col("title").contains(" / "), person).alias("authors"), nonempty(after).alias("publisher"), "labels",
    )

