"""Reference lists in running text: section search, entry segmentation, and field extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import nonempty
from .bibtex import first, people

#: Fixed headings, tried in this order.
MARKERS = ("References", "REFERENCES", "Bibliography", "BIBLIOGRAPHY", "Works Cited", "WORKS CITED", "Literature", "LITERATURE")
#: Fixed signs of a new entry, by style of the list. In the first style a line of an author's name counts, too, if a year in brackets is in its first YEAR_WITHIN characters.
YEAR_WITHIN, NAME, DATED = 80, r"^[A-Z][a-z]+", r"\(\d{4}[a-z]?\)"
NEW_ENTRY = {
    "initials": r"^[A-Z][a-z]+,\s+[A-Z]\.|^[—–]",
    "dated": r"^[A-Z—].*\(\d{4}[a-z]?\)|^—",
    "capital": r"^[A-Z].*\(\d{4}[a-z]?\.?\)",
}
#: Fixed repairs of accents that extraction from print leaves apart.
ACCENTS = (("´ o", "ó"), ("¨ a", "ä"), ("¨ o", "ö"), ("¨ u", "ü"), ("´ a", "á"), ("´ e", "é"), ("´ i", "í"), ("´ u", "ú"), ("` a", "à"), ("` e", "è"), ("` o", "ò"), ("ˆ o", "ô"))
QUOTED = "[\"“'‘]([^\"”'’]+)[\"”'’]"
EDGES = ".,;:\"'“”‘’ "


def section(text: Column) -> Column:
    """From the first heading (in the order of MARKERS) on a line of its own; the whole text without one."""
    found = []
    for m in MARKERS:
        at = F.coalesce(F.nullif(F.locate(f"\n{m}\n", text), F.lit(0)), F.nullif(F.locate(f"\n{m} \n", text), F.lit(0)))
        found.append(at)
    return F.coalesce(F.substring(text, F.coalesce(*found), F.length(text)), text)


def section_after(text: Column) -> Column:
    """After the first of four headings, in any case; else from an entry-like line in the last two fifths; else null."""
    after = [first(text, rf"(?is)\n{m}\s*\n(.*)$") for m in ("References", "Bibliography", "Works Cited", "Literature")]
    tail = F.substring(text, F.floor(F.length(text) * 0.6).cast("int") + 1, F.length(text))
    return F.coalesce(*after, first(tail, r"(?s)(\n[A-Z][a-z]+,\s+[A-Z][a-z]+[^\n]*?\(\d{4}\).*)$"))


def repaired(text: Column) -> Column:
    out = F.regexp_replace(text, r"([a-z])-\s+([a-z])", "$1$2")
    for broken, whole in ACCENTS:
        out = F.replace(out, F.lit(broken), F.lit(whole))
    return out


def lines(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """key, place and line (trimmed) of the lines that aren't blank."""
    cut = docs.select(key, F.posexplode(F.split(column, "\n")).alias("place", "line")).withColumn("line", F.trim(F.regexp_replace("line", r"(?U)^\s+|\s+$", "")))
    return cut.where(F.col("line") != "")


def begins(line: Column, style: str) -> Column:
    """Whether a line begins an entry of a list of the style."""
    found = line.rlike(NEW_ENTRY[style])
    return found | (line.rlike(NAME) & F.substring(line, 1, YEAR_WITHIN).rlike(DATED)) if style == "initials" else found


def segment(rows: DataFrame, key: str = "doc_id", style: str = "initials") -> DataFrame:
    """key, entry_no and entry: a line that begins an entry, and those up to the next one, joined by spaces; lines before the first are dropped.

    A document's lines are ordered within that document alone, so that documents are spread over the cluster.
    """
    order = Window.partitionBy(key).orderBy("place")
    marked = rows.withColumn("entry_no", F.count_if(begins(F.col("line"), style)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), " ")
    return marked.where(F.col("entry_no") > 0).groupBy(key, "entry_no").agg(joined.alias("entry"))


def year(s: Column) -> Column:
    return F.coalesce(first(s, r"\((\d{4})[a-z]?\)"), first(s, r"\b(19\d{2}|20\d{2})[.\s]")).cast("int")


def pages(s: Column) -> tuple[Column, Column]:
    """First and last page: 'pp. 1-2', 'p. 1', then a bare range."""
    marked, single, bare = r"pp?\.\s*(\d+)[-–—]+(\d+)", r"pp?\.\s*(\d+)", r"\b(\d+)[-–—]+(\d+)\b"
    end = F.when(s.rlike(marked), first(s, marked, 2)).when(s.rlike(single), F.lit(None).cast("string")).otherwise(first(s, bare, 2))
    return F.coalesce(first(s, marked), first(s, single), first(s, bare)), end


def doi(s: Column) -> Column:
    return F.regexp_replace(F.coalesce(first(s, r"(?i)doi:\s*([^\s,]+)"), first(s, r"\b(10\.\d{4,}/[^\s,]+)")), r"[.,;]+$", "")


def title(s: Column, y: Column) -> Column:
    """Quoted text; else text after the year in one of three forms, of more than ten characters."""
    trimmed = lambda x: F.when(F.length(F.trim(F.btrim(x, F.lit(EDGES)))) > 10, F.btrim(x, F.lit(EDGES)))
    of_year = lambda pattern: F.when(first(s, pattern) == y.cast("string"), trimmed(first(s, pattern, 2)))
    quoted = F.when(s.rlike(QUOTED), F.rtrim(F.trim(first(s, QUOTED)), F.lit(".,;:")))
    return F.coalesce(quoted, of_year(r"\((\d{4})[a-z]?\)\.\s+([^.]+?)\."), of_year(r"\((\d{4})[a-z]?\)\s+([^:.]+)"), of_year(r"\s(\d{4})\.\s+([^.]+?)\."))


def authors_before(s: Column, y: Column) -> Column:
    """People named before the year, in brackets or followed by a full stop; dashes for the same author are none."""
    bracket, plain = r"^(.+?)\s*\((\d{4})[a-z]?\)", r"^(.+?)\s+(\d{4})\."
    lead = F.coalesce(F.when(first(s, bracket, 2) == y.cast("string"), first(s, bracket)), F.when(first(s, plain, 2) == y.cast("string"), first(s, plain)))
    return people(F.regexp_replace(lead, r"^[—–]\s*", ""), r"\s+and\s+|\s+&\s+", r"[.,;]+$")


def parse(entries: DataFrame, key: str = "doc_id", inherit: bool = False) -> DataFrame:
    """Raw-text records of entries (key, entry_no, entry), with key and entry_no.

    Kept are entries with a title of five characters or more, a year and authors; inherit: an entry of a dash takes the
    authors of the last one that has some.
    """
    e = F.col("entry")
    rows = entries.withColumns({"year": year(e), "doi": doi(e)})
    rows = rows.withColumns({"title": title(e, F.col("year")), "authors": authors_before(e, F.col("year"))})
    if inherit:
        past = Window.partitionBy(key).orderBy("entry_no").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("authors", F.coalesce("authors", F.last("authors", ignorenulls=True).over(past)))
    kind = F.when(e.contains("In:") | e.contains("In "), "incollection").when(e.rlike(r"(?i)\bvol\.\s*\d+"), "book").otherwise("article")
    after = F.expr("substring(entry, instr(entry, title) + length(title))")
    name = F.btrim(F.regexp_replace(F.regexp_replace(first(after, r"^([^.\d]+)"), r"^\s*[,.]?\s*", ""), r"\s*\d+.*$", ""), F.lit(".,;: "))
    start, end = pages(e)
    issue = r"\b(\d+)\s*\((\d+)\)"
    out = rows.select(
        key, "entry_no", e.alias("raw_text"), kind.alias("type"), "title", "year", F.lit(None).cast("string").alias("pubstate"), "authors", F.lit(None).cast("array<struct<given:string,family:string>>").alias("editors"),
        F.when((kind == "article") & (F.length(name) > 2), name).alias("journal"), F.coalesce(first(e, issue), first(e, r"(?i)\bvol\.\s*(\d+)")).alias("volume"), first(e, issue, 2).alias("issue_number"),
        start.alias("start_page"), end.alias("end_page"), F.lit(None).cast("string").alias("publisher"), nonempty(F.col("doi")).alias("doi"), F.lit(None).cast("string").alias("url"),
    )
    return out.where(F.col("title").isNotNull() & F.col("year").isNotNull() & F.col("authors").isNotNull() & (F.length("title") >= 5) & ~F.col("title").startswith("In:"))


def parse_unquoted(entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """Records of 'Author (year). Title. Journal, vol (issue), pages.' without quotes around titles, and of chapters 'Title. In ...'."""
    e = repaired(F.col("entry"))
    dated = r"\((?:\d{4}[a-z]?\.?\s+)?\((\d{4})[a-z]?\)\)|\((\d{4})[a-z]?\.?\)"
    y = F.coalesce(nonempty(first(e, dated)), first(e, dated, 2)).cast("int")
    rest = F.trim(F.regexp_replace(first(e, rf"^.*?(?:{dated})(.*)$", 3), r"^\s*\.\s*", ""))
    lead = F.rtrim(F.trim(first(e, rf"^(.*?)(?:{dated})")), F.lit("."))
    placed = r"^(.*)\.\s+([^.]*?),\s*(\d+)\s*(?:\((\d+)\))?,\s*(\d+)(?:\s*[-–—]+\s*(\d+))?"
    chapter, book = r"^(.*?)\.\s*In\s+(.*)$", r"^(.*?)\.\s+(.*)$"
    kind = F.when(rest.rlike(chapter), "incollection").when(rest.rlike(placed), "article").otherwise("book")
    of = lambda k, pattern, group: F.when(F.col("type") == k, nonempty(F.trim(first(F.col("rest"), pattern, group))))
    past = Window.partitionBy(key).orderBy("entry_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = entries.select(key, "entry_no", e.alias("raw_text"), y.alias("year"), rest.alias("rest"), kind.alias("type"), people(F.when(lead != "—", lead), r"\s+(?:and|&)\s+", r",+$").alias("authors"))
    rows = rows.where(F.col("year").isNotNull())
    bare = F.rtrim(F.coalesce(first(F.col("rest"), book), F.col("rest")), F.lit("."))
    return rows.select(
        key, "entry_no", "raw_text", "type", F.coalesce(of("incollection", chapter, 1), of("article", placed, 1), nonempty(F.trim(bare))).alias("title"), "year", F.lit(None).cast("string").alias("pubstate"),
        F.coalesce("authors", F.last("authors", ignorenulls=True).over(past)).alias("authors"), F.lit(None).cast("array<struct<given:string,family:string>>").alias("editors"),
        of("article", placed, 2).alias("journal"), of("article", placed, 3).alias("volume"), of("article", placed, 4).alias("issue_number"), of("article", placed, 5).alias("start_page"), of("article", placed, 6).alias("end_page"),
        F.rtrim(of("book", book, 2), F.lit(".")).alias("publisher"), nonempty(doi(F.col("raw_text"))).alias("doi"), F.lit(None).cast("string").alias("url"),
    ).where(F.col("title").isNotNull())


def annotated(rows: DataFrame, comment: str = "comment on update", key: str = "match_1_bibkey") -> DataFrame:
    """annotation_type and expected_bibkey of a reviewer's comment; blank, unneeded and unknown ones are dropped."""
    c = F.trim(F.col(f"`{comment}`"))
    kind = F.when(c == "RIGHT KEY", "RIGHT_KEY").when(c == "NOT IN BIBLIO", "NOT_IN_BIBLIO").when(c.startswith("WRONG KEY"), "WRONG_KEY")
    expected = F.when(c == "RIGHT KEY", F.trim(F.col(f"`{key}`"))).when(c.startswith("WRONG KEY"), F.regexp_extract(c, r"RIGHT ONE IS:\s*(\S+)", 1)).otherwise("")
    return rows.withColumns({"annotation_type": kind, "expected_bibkey": expected}).where(F.col("annotation_type").isNotNull())
