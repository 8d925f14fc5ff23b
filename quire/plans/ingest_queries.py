"""Ingestion queries: sources are texts derived from the bibliography view, so that SQL can say what parsing must give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bibtex, crossref, html, output, rawtext, reflist
from .bibview import ALL_SQL, ASCII_SQL, bib_view
from .queries import query

SPLIT = "CASE WHEN contains(author, ',') THEN string_split(author, ', ')[{}] ELSE string_split(author, ' ')[{}] END"
FAMILY, GIVEN = SPLIT.format(1, -1), SPLIT.format(2, 1)


def works(view: DataFrame) -> DataFrame:
    """A JSON work for each record; some are broken, of wrong types, without a journal, or with null dates."""
    i = F.col("item_index")
    person = F.struct(F.when(F.col("author").contains(","), F.substring_index("author", ", ", -1)).otherwise(F.substring_index("author", " ", 1)).alias("given"), F.try_element_at("author_surnames", F.lit(1)).alias("family"))
    date = F.when(F.col("year").isNotNull(), F.struct(F.array(F.array(F.col("year"), F.lit(5))).alias("date-parts")))
    work = F.to_json(
        F.struct(
            F.col("doi").alias("DOI"), F.array("title").alias("title"), F.array(person).alias("author"), F.when(i % 31 != 0, F.array("journal")).alias("container-title"), date.alias("issued"), "volume",
            F.col("number").alias("issue"), F.replace(F.col("pages"), F.lit("--"), F.lit("-")).alias("page"), "publisher", F.array(F.lit("1234-5678"), F.lit("8765-4321")).alias("ISSN"),
        )
    )
    number = F.regexp_replace(work, '"volume":"(\\d+)"', '"volume":$1')
    hole = F.regexp_replace(work, r'\{"date-parts":\[\[\d+,5\]\]\}', '{"date-parts":[[null]]}')
    return view.select("item_index", F.when(i % 23 == 0, F.concat(F.lit("{"), work)).when(i % 29 == 0, number).when((i % 37 == 0) & F.col("year").isNotNull(), hole).otherwise(work).alias("raw"))


BAD = "item_index % 23 = 0 OR item_index % 29 = 0 OR item_index % 31 = 0 OR (item_index % 37 = 0 AND year IS NOT NULL)"


@query(f"""WITH {ASCII_SQL} SELECT item_index, CASE WHEN {BAD} THEN 'error' ELSE 'success' END AS parsing_status, CASE WHEN NOT ({BAD}) THEN {FAMILY} || ', ' || {GIVEN} END AS author,
  CASE WHEN NOT ({BAD}) THEN title END AS title, CASE WHEN NOT ({BAD}) THEN year END AS year, CASE WHEN NOT ({BAD}) THEN journal END AS journal, CASE WHEN NOT ({BAD}) THEN pages END AS pages, CASE WHEN NOT ({BAD}) THEN coalesce(doi, '') END AS doi, CASE WHEN NOT ({BAD}) THEN '1234-5678/8765-4321' END AS issn FROM bib""")
def crossref_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = crossref.parse(works(bib_view(spark, sf_dir, ascii_only=True)))
    return parsed.select(
        "item_index", "parsing_status", output.authors_text(F.col("out.author")).alias("author"), F.col("out.title").alias("title"), F.col("out.year").alias("year"), F.col("out.journal").alias("journal"),
        output.pages_text(F.col("out.pages")).alias("pages"), F.col("out.doi").alias("doi"), F.concat_ws("/", F.when(F.col("out").isNotNull(), F.col("out.issn_print")), F.col("out.issn_electronic")).alias("issn"),
    ).withColumn("issn", F.when(F.col("parsing_status") == "success", F.col("issn")))


PLAIN = "regexp_full_match(title, '[A-Za-z ,.]+')"


@query(f"""WITH {ALL_SQL} SELECT item_index, CASE item_index % 3 WHEN 0 THEN 'incollection' WHEN 1 THEN 'inproceedings' ELSE 'article' END AS type, title, CASE WHEN item_index % 5 <> 0 THEN year END AS year,
  CASE WHEN item_index % 5 = 0 THEN 'forthcoming' END AS pubstate, {FAMILY} || ', ' || {GIVEN} || ' and Doe, Jane' AS authors, journal, volume, number, split_part(pages, '--', 1) AS start_page, split_part(pages, '--', 2) AS end_page, doi FROM bib WHERE {PLAIN}""")
def bibtex_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = bib_view(spark, sf_dir).where(F.col("title").rlike("^[A-Za-z ,.]+$"))
    i = F.col("item_index")
    kind = F.when(i % 3 == 0, "InBook").when(i % 3 == 1, "conference").otherwise("ARTICLE")
    year = F.when(i % 5 == 0, "In press").otherwise(F.coalesce(F.col("year").cast("string"), F.lit("n.d.")))
    line = lambda name, x: F.concat(F.lit(f"  {name} = {{"), x, F.lit("},\n"))
    entry = F.concat(
        F.lit("@"), kind, F.lit("{"), F.col("bibkey"), F.lit(",\n"), line("title", F.col("title")), line("author", F.concat("author", F.lit(" AND Jane Doe"))), line("year", year), line("journal", F.col("journal")),
        line("volume", F.col("volume")), line("number", F.col("number")), line("pages", F.col("pages")), F.coalesce(line("doi", F.col("doi")), F.lit("")), F.lit("}"),
    )
    # files of about ten entries, cut again into entries
    files = view.groupBy(F.expr("item_index div 10").alias("f")).agg(F.array_join(F.collect_list(entry), "\n").alias("value"))
    parsed = bibtex.parse(bibtex.entries(files))
    key = F.regexp_extract("raw_text", r"\{key:(\d+),", 1).cast("long")
    return parsed.select(key.alias("item_index"), "type", "title", "year", "pubstate", output.authors_text(F.col("authors")).alias("authors"), "journal", "volume", F.col("issue_number").alias("number"), "start_page", "end_page", "doi")


LIST = f"""lst AS (SELECT item_index // 10 AS doc_id, item_index, CASE WHEN author LIKE '%,%' AND year IS NOT NULL THEN author ELSE 'Adams, E.' END || ' (' || coalesce(year, 1999) || 'a). ''' || title || '''.' AS head,
  journal || ', ' || volume || ' (' || number || '), pp. ' || replace(pages, '--', '-') || coalesce(' doi:' || doi || '.', '') AS tail FROM bib WHERE {PLAIN})"""


def reference_list(view: DataFrame) -> DataFrame:
    """Documents of reference lists, two lines and a blank one for each record, after a heading."""
    i = F.col("item_index")
    head = F.concat(F.when(F.col("author").contains(",") & F.col("year").isNotNull(), F.col("author")).otherwise("Adams, E."), F.lit(" ("), F.coalesce("year", F.lit(1999)).cast("string"), F.lit("a). '"), F.col("title"), F.lit("'."))
    tail = F.concat("journal", F.lit(", "), "volume", F.lit(" ("), "number", F.lit("), pp. "), F.replace("pages", F.lit("--"), F.lit("-")), F.coalesce(F.concat(F.lit(" doi:"), "doi", F.lit(".")), F.lit("")))
    rows = view.where(F.col("title").rlike("^[A-Za-z ,.]+$")).select(F.expr("item_index div 10").alias("doc_id"), i, F.concat(head, F.lit("\n  "), tail, F.lit("\n\n")).alias("x"))
    return rows.groupBy("doc_id").agg(F.concat(F.lit("Some text.\nReferences\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_index", "x"))), lambda r: r["x"]), "")).alias("text"))


@query(f"WITH {ALL_SQL}, {LIST} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY item_index) AS BIGINT) AS entry_no, head || ' ' || tail AS entry FROM lst")
def reference_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reference_list(bib_view(spark, sf_dir)).withColumn("text", reflist.section(F.col("text")))
    return reflist.segment(reflist.lines(docs))


@query(f"""WITH {ALL_SQL}, {LIST} SELECT l.item_index // 10 AS doc_id, CASE WHEN contains(head || ' ' || tail, 'In ') THEN 'incollection' ELSE 'article' END AS type, rtrim(title, '.,;:') AS title, coalesce(year, 1999) AS year,
  CASE WHEN author LIKE '%,%' AND year IS NOT NULL THEN {FAMILY} || ', ' || rtrim({GIVEN}, '.') ELSE 'Adams, E' END AS authors, volume, number, split_part(pages, '--', 1) AS start_page, split_part(pages, '--', 2) AS end_page, doi FROM lst l JOIN bib USING (item_index) WHERE length(rtrim(title, '.,;:')) >= 5 AND NOT starts_with(title, 'In:')""")
def reference_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reference_list(bib_view(spark, sf_dir)).withColumn("text", reflist.section_after(F.col("text")))
    parsed = reflist.parse(reflist.segment(reflist.lines(docs)))
    return parsed.select("doc_id", "type", "title", "year", output.authors_text(F.col("authors")).alias("authors"), "volume", F.col("issue_number").alias("number"), "start_page", "end_page", "doi")


@query(f"""WITH {ASCII_SQL} SELECT item_index, CASE WHEN item_index % 6 = 0 THEN 'error' ELSE 'success' END AS parsing_status, CASE WHEN item_index % 6 <> 0 THEN coalesce(nullif('', ''), 'article') END AS entry_type,
  CASE WHEN item_index % 6 = 0 THEN NULL WHEN item_index % 4 = 0 THEN 'Editor, Ann' ELSE {FAMILY} || ', ' || {GIVEN} END AS author, CASE WHEN item_index % 6 <> 0 THEN split_part(pages, '--', 1) END AS pages FROM bib""")
def rawtext_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without authors take their editors; those without a title are errors."""
    view, i = bib_view(spark, sf_dir, ascii_only=True), F.col("item_index")
    person = F.array(F.struct(F.when(F.col("author").contains(","), F.substring_index("author", ", ", -1)).otherwise(F.substring_index("author", " ", 1)).alias("given"), F.try_element_at("author_surnames", F.lit(1)).alias("family")))
    none = F.lit(None).cast("string")
    raw = view.select(
        "item_index", none.alias("raw_text"), F.lit("article").alias("type"), F.when(i % 6 != 0, F.col("title")).alias("title"), "year", none.alias("pubstate"), F.when(i % 4 != 0, person).alias("authors"),
        F.array(F.struct(F.lit("Ann").alias("given"), F.lit("Editor").alias("family"))).alias("editors"), "journal", "volume", F.col("number").alias("issue_number"), F.substring_index("pages", "--", 1).alias("start_page"),
        none.alias("end_page"), "publisher", "doi", none.alias("url"),
    )
    parsed = rawtext.convert(raw)
    found = F.col("out").isNotNull()
    return parsed.select("item_index", "parsing_status", F.col("out.entry_type").alias("entry_type"), F.when(found, output.authors_text(F.col("out.author"))).alias("author"), F.when(found, output.pages_text(F.col("out.pages"))).alias("pages"))


@query(f"""WITH {ALL_SQL} SELECT item_index, CASE item_index % 6 WHEN 0 THEN 'RIGHT_KEY' WHEN 1 THEN 'NOT_IN_BIBLIO' ELSE 'WRONG_KEY' END AS annotation_type, CASE item_index % 6 WHEN 0 THEN bibkey WHEN 1 THEN '' ELSE 'key:1' END AS expected_bibkey FROM bib WHERE item_index % 6 < 3""")
def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_index") % 6
    comment = F.when(i == 0, " RIGHT KEY").when(i == 1, "NOT IN BIBLIO").when(i == 2, "WRONG KEY, RIGHT ONE IS: key:1 ").when(i == 3, "NOT NEEDED").when(i == 4, "who knows")
    rows = bib_view(spark, sf_dir).select("item_index", comment.alias("comment on update"), F.col("bibkey").alias("match_1_bibkey"))
    return reflist.annotated(rows).select("item_index", "annotation_type", "expected_bibkey")


@query("SELECT page_id, CAST(count(DISTINCT link) AS BIGINT) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS link FROM pages) GROUP BY 1")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return html.links(pages).groupBy("page_id").agg(F.count("*").alias("links"))


@query()
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.texts(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")).drop("html")
