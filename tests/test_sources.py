import re
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.operators import bibtex, blocking, comparators, crossref, html, output, quality, rawtext, reflist
from quire.sources import readers, sinks
from quire.streaming import matching as streaming

ITEM = "item_index long, doi string, title string, author_surnames array<string>, year int, journal string"


def test_csv_keys_and_row_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text('bibkey,title\nk1,"a, ""b""\nc"\n,second\n,third\n', encoding="utf-8")
    rows = readers.read_staged(spark, str(tmp_path / "a.csv")).orderBy("row_id").collect()
    assert [(r.row_id, r.bibkey) for r in rows] == [(0, "k1"), (1, "temp:3"), (2, "temp:4")] and rows[0].title == 'a, "b"\nc'
    with pytest.raises(ValueError, match="neither"):
        readers.read_staged(spark, "x.txt")
    many = readers.with_row_id(spark.range(100).repartition(7)).collect()
    assert sorted(r.row_id for r in many) == list(range(100))


def ods(rows):
    cell = lambda v: f"<table:table-cell><text:p>{v}</text:p></table:table-cell>" if v else '<table:table-cell table:number-columns-repeated="1"/>'
    body = "".join(f"<table:table-row>{''.join(map(cell, r))}</table:table-row>" for r in rows)
    names = 'xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("content.xml", f"<d {names}><table:table>{body}</table:table></d>")
    return out.getvalue()


def test_ods_and_docx(spark, tmp_path):
    (tmp_path / "b.ods").write_bytes(ods([["bibkey", "title"], ["k", "one"], ["", "two"], ["k", "three"]]))
    assert [(r.bibkey, r.title) for r in readers.read_bibliography(spark, str(tmp_path / "b.ods")).orderBy("bibkey").collect()] == [("k", "three"), ("temp:3", "two")]
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>Two</w:t></w:r></w:p></w:document>')
    (tmp_path / "e.docx").write_bytes(b"no zip")
    rows = {r.path[-6:]: r for r in readers.read_documents(spark, str(tmp_path / "*.docx")).collect()}
    assert rows["d.docx"].text == "One\nTwo" and rows["e.docx"].parsing_status == "error"


def test_url_list(spark, tmp_path):
    (tmp_path / "u.txt").write_text(" http://a \n\nhttp://b\n")
    assert [r.url for r in readers.read_urls(spark, str(tmp_path / "u.txt"), "http://c").collect()] == ["http://a", "http://b", "http://c"]


def test_fetch_and_model(spark):
    def get(url):
        if "bad" in url:
            raise OSError("gone")
        return f"<html><script>x</script><p>Title of {url}</p></html>"

    urls = spark.createDataFrame([("http://good",), ("http://bad",)], "url string")
    pages = {r.url: r for r in html.texts(readers.fetch(urls, pause=0, get=get).select("url", "html")).collect()}
    assert pages["http://good"].text == "Title of http://good" and pages["http://bad"].parsing_status == "error"

    def client():
        return lambda text: json.dumps([{"title": text, "year": 2000, "number": "7"}]) if text != "boom" else 1 / 0

    answers = readers.ask_model(spark.createDataFrame([("t",), ("boom",)], "text string"), client)
    good = rawtext.parse_answers(answers.where("parsing_status = 'success'")).first()
    assert (good.title, good.year, good.issue_number) == ("t", 2000, None)
    assert answers.where("parsing_status = 'error'").first().message.startswith("ZeroDivisionError")


def test_works_source_prunes_years(spark):
    reader = readers.WorksReader({"from": "1990", "until": "1995", "base": "http://x"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    rest = list(reader.pushFilters([EqualTo(("year",), 1992), GreaterThan(("raw",), "a")]))
    assert len(rest) == 1 and [p.year for p in reader.partitions()] == [1992]
    assert readers.WorksReader({"from": "2000", "until": "1999"}).partitions() == []


@pytest.fixture
def works_server():
    """Two pages of works for a journal by cursor, and one work by DOI."""
    import threading
    import urllib.parse
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            url = urllib.parse.urlparse(self.path)
            query = urllib.parse.parse_qs(url.query)
            work = lambda title, year: {"title": [title], "container-title": ["J"], "author": [{"family": "Hegel"}], "issued": {"date-parts": [[year]]}}
            if url.path == "/journals/1234/works":
                year = int(query["filter"][0].split(":")[1].split(",")[0])
                message = {"items": [work(f"t{i}", year) for i in range(1000 if query["cursor"] == ["*"] else 3)], "next-cursor": "more"}
            else:
                message = work(urllib.parse.unquote(url.path), 1948)
            body = json.dumps({"message": message}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_works_through_the_source_and_the_command_line(spark, works_server, tmp_path):
    readers.register(spark)
    works = spark.read.format("works").options(base=works_server, issn="1234", until="1992", **{"from": "1990"}).load()
    assert {r.year: r["count"] for r in works.groupBy("year").count().collect()} == {1990: 1003, 1991: 1003, 1992: 1003}
    assert works.where("year = 1991").count() == 1003
    one = crossref.parse(spark.read.format("works").options(base=works_server, doi="10.1/x").load()).first()
    assert one.parsing_status == "success" and one.out.title == "/works/10.1/x"
    from quire import cli

    cli.journal(spark, cli.parser().parse_args(["journal", "--base", works_server, "--issn", "1234", "--first", "1990", "--until", "1990", "--output", str(tmp_path / "out")]))
    assert readers.read_csv(spark, str(tmp_path / "out")).where("parsing_status = 'success'").count() == 1003


def test_matches_of_a_kept_index(spark, tmp_path):
    from quire import cli

    lines = ["bibkey,title,author,date,journal"] + [f'k{i},Title number {i} of words,"Family{i}, Given",19{i:02d},J' for i in range(30)]
    (tmp_path / "bib.csv").write_text("\n".join(lines))
    (tmp_path / "in.csv").write_text("\n".join([lines[0], lines[8], lines[21]]))
    out = []
    for extra in ([], ["--cache", str(tmp_path / "kept")], ["--cache", str(tmp_path / "kept")]):
        cli.match_files(spark, cli.parser().parse_args(["match", "--bibliography", str(tmp_path / "bib.csv"), "--input", str(tmp_path / "in.csv"), "--output", str(tmp_path / "out"), *extra]))
        out.append(sorted((r.match_1_bibkey, r.match_1_score, r.match_2_bibkey) for r in readers.read_csv(spark, str(tmp_path / "out")).collect()))
    assert out[0] == out[1] == out[2] and [x[0] for x in out[0]] == ["k20", "k7"]
    assert len(list((tmp_path / "kept").iterdir())) == 1


def test_an_entry_has_its_year_in_the_first_80_characters(spark):
    from quire.operators import reflist

    rows = [f"Name {'x' * n} (1999) rest" for n in (10, 68, 69, 70, 90)] + ["Adams, E. no year", "— (1990) same", "lower (1990)"]
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, line string")
    got = [r.b for r in frame.select("i", reflist.begins(F.col("line"), "initials").alias("b")).orderBy("i").collect()]
    assert got == [bool(re.match("[A-Z][a-z]+", r) and re.search(r"\(\d{4}[a-z]?\)", r[:80])) or i in (5, 6) for i, r in enumerate(rows)] and got[1] and not got[4]


def test_score_text_is_the_shortest(spark):
    from quire.operators import output

    rows = [(1, j, f"k{j}", "e", x) for j, x in enumerate((12.5, 12.0, 3.14159, 100.256), 1)]
    got = output.wide(spark.createDataFrame(rows, "subject_index int, rank int, bibkey string, full_entry string, total_score double"), 4).first()
    assert [got[f"match_{j}_score"] for j in (1, 2, 3, 4)] == ["12.5", "12.0", "3.14", "100.26"]


def test_json_records(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"title": "A", "editors": [{"given": "G", "family": "F"}], "number": "3"}')
    (tmp_path / "two.json").write_text('[{"title": "B", "authors": [{"family": "X"}], "start_page": "1", "year": 1999}, {"year": 3}]')
    rows = {r.title: r for r in rawtext.convert(rawtext.from_json_files(spark, str(tmp_path))).collect()}
    assert rows["A"].out.author[0].family == "F" and rows["A"].out.entry_type == "UNKNOWN" and rows["A"].out.number == ""
    assert rows["B"].out.pages[0].start == "1" and rows[None].parsing_status == "error" and rows[None].out is None


def test_crossref_errors_and_lists(spark):
    good = {"title": ["ÊTRE", "ET PENSÉE"], "author": [{"family": "Hegel"}], "container-title": ["J"], "issued": {"date-parts": [[1948, 5]]}, "page": "169-184", "ISSN": ["1", "2"]}
    rows = [json.dumps(good), "{", json.dumps(good | {"volume": 3}), json.dumps(good | {"title": "x"}), json.dumps(good | {"issued": {"date-parts": [[None]]}}), json.dumps({k: v for k, v in good.items() if k != "container-title"}), None]
    got = crossref.parse(spark.createDataFrame(list(enumerate(rows)), "i int, raw string")).orderBy("i").collect()
    assert [r.parsing_status for r in got] == ["success"] + ["error"] * 6
    out = got[0].out
    assert (out.title, out.author[0].family, out.author[0].given, out.year, out.pages[0].end, out.issn_electronic) == ("ÊTRE ET PENSÉE", "Hegel", "", 1948, "184", "2")
    response = spark.createDataFrame([(json.dumps({"message": {"items": [good, good]}}),)], "response string")
    assert crossref.successes(crossref.parse(crossref.items_of_responses(response))).count() == 2
    assert [r.year for r in crossref.pages_of_years("1", 2000, 2002, spark).collect()] == [2000, 2001, 2002] and crossref.pages_of_years("1", 3, 2, spark).count() == 0


def test_bibtex(spark, tmp_path):
    text = '@conference{a,\n title = {Loving {{Someone}} in\n  Time},\n year = {2024a}, author = {Doe, Jane and Ann B. Roe},\n pages = {12--34}}\n@misc{b, year = {1}}\n@Book{c, title = "T", year={in press}, editor={Solo}, pages={7}}'
    (tmp_path / "x.bib").write_text(text, encoding="utf-8")
    entries = bibtex.read_entries(spark, str(tmp_path / "x.bib"))
    assert entries.count() == 3
    rows = {r.type: r for r in bibtex.parse(entries).collect()}
    a = rows["inproceedings"]
    assert (a.title, a.year, a.start_page, a.end_page) == ("Loving Someone", None, "12", "34") and [(p.given, p.family) for p in a.authors] == [("Jane", "Doe"), ("Ann B.", "Roe")]
    assert rows["book"].pubstate == "forthcoming" and rows["book"].editors[0].family == "Solo" and rows["book"].start_page == "7"
    assert {r.title for r in bibtex.parse(entries, balanced=True).collect()} >= {"Loving Someone in Time"}


def test_reference_lists(spark):
    text = "Intro\nReferences\nnoise\nDoe, J. (1999). 'A quoted title here', Journal of\n Things 12 (3), pp. 4-5. doi:10.1/x.\n— (2001). Another title of it. Press.\nRoe, Ann & Poe, B. 2005. Standalone year titles. Acme, 7 (2), 10."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").withColumn("text", reflist.section_after(F.col("text")))
    entries = reflist.segment(reflist.lines(docs))
    assert entries.count() == 2
    rows = reflist.parse(entries, inherit=True).orderBy("entry_no").collect()
    assert (rows[0].title, rows[0].year, rows[0].volume, rows[0].issue_number, rows[0].start_page, rows[0].end_page, rows[0].doi) == ("A quoted title here", 1999, "12", "3", "4", "5", "10.1/x")
    assert rows[1].title == "Another title of it" and rows[1].authors[0].family == "Doe"
    osborn = spark.createDataFrame([(1, 1, "Ab, C. (2009a). A title. Some Journal, 12 (3), 45-67."), (1, 2, "— (1854 (2016)). Chapter. In Book of Things.")], "doc_id long, entry_no int, entry string")
    a, b = reflist.parse_unquoted(osborn).orderBy("entry_no").collect()
    assert (a.title, a.journal, a.volume, a.start_page, a.year) == ("A title", "Some Journal", "12", "45", 2009) and (b.title, b.type, b.authors[0].family) == ("Chapter", "incollection", "Ab")
    assert spark.range(1).select(reflist.repaired(F.lit("Alchourr´ on devel- oped"))).first()[0] == "Alchourrón developed"


def test_html_records_and_items(spark):
    page = """<html><head><meta name="citation_title" content="M"><meta name="citation_author" content="Roe, Ann"><meta name="citation_doi" content="10.1/z"><meta name="citation_journal_title" content="J">
    <script type="application/ld+json">{"name": "LD title", "creator": [{"name": "Jane Doe"}], "datePublished": "2011-05-02"}</script></head><body><a href="/d/1">x</a><a href="/d/1">y</a><a href="/e">z</a>
    <ul><li class="element-list" id="n1"><h2>Thesis on X / Poe, Edgar</h2><div class="description">Fribourg : Uni, 2003</div><dl><dt>Year:</dt><dd>2003</dd></dl></li></ul><span>Results: 42</span></body></html>"""
    pages = spark.createDataFrame([(1, page), (2, "<p>none")], "page_id long, html string")
    r = html.records(pages).first()
    assert (r.title, r.year, r.authors[0].family, r.doi, r.journal) == ("LD title", 2011, "Doe", "10.1/z", "J")
    assert [(x.place, x.link) for x in html.links(pages, r"^/d/").collect()] == [(0, "/d/1")]
    item = html.catalogue(pages).first()
    assert (item.title, item.authors[0].family, item.year, item.publisher, item.labels) == ("Thesis on X", "Poe", 2003, "Uni", {"year": "2003"})
    assert pages.select(html.total_count(F.col("html"))).first()[0] == 42


def test_index_cache_is_by_content(spark, tmp_path):
    items = spark.createDataFrame([(1, "d", "A title", ["Doe"], 1999, "J")], ITEM)
    first = sinks.cached_postings(items, str(tmp_path)).count()
    assert first == blocking.postings(items).count() == sinks.cached_postings(items, str(tmp_path)).count()
    changed = items.withColumn("title", F.lit("Another, longer title"))
    assert sinks.cached_postings(changed, str(tmp_path)).count() > first
    assert sinks.load_postings(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(TypeError):
        sinks.load_postings(spark, str(tmp_path / "other"))


def test_record_sink(spark, tmp_path):
    raw = spark.createDataFrame([("T", "a"), (None, "b")], "title string, journal string")
    for c in rawtext.FIELDS:
        if c not in raw.columns:
            kind = "array<struct<given:string,family:string>>" if c in ("authors", "editors") else "int" if c == "year" else "string"
            raw = raw.withColumn(c, F.lit(None).cast(kind))
    sinks.write_records(rawtext.convert(raw), str(tmp_path / "o"))
    back = readers.read_csv(spark, str(tmp_path / "o"))
    assert back.columns == list(output.BIBLIOGRAPHY_COLUMNS) and sorted((r.title, r.date, r.parsing_status) for r in back.collect()) == [("", "", "error"), ("T", "no date", "success")]


def test_stream(spark, tmp_path):
    schema = "subject_index long, title string, author string, author_surnames array<string>, year int, doi string, journal string, volume string, number string, pages string, publisher string"
    items = spark.createDataFrame([(1, "A title", "Doe, Jane", ["Doe"], 1999, None, None, None, None, None, None)], schema).withColumnRenamed("subject_index", "item_index")
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(json.dumps({"subject_index": i, "title": "A title", "author": "Doe, J.", "author_surnames": ["Doe"], "year": 1999}))
    told = []
    listener = streaming.Progress(told.append, 2)
    spark.streams.addListener(listener)
    streaming.match_stream(streaming.read_records(spark, str(source), schema), items, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(240)
    spark.streams.removeListener(listener)
    assert sorted(int(r.subject_index) for r in spark.read.csv(f"{tmp_path}/out/*", header=True).collect()) == [0, 1, 2]


def test_comparators(spark):
    side = "struct<title:string,author:string,year:int,doi:string,journal:string,volume:string,number:string,pages:string,publisher:string>"
    a = ("Introduction to Philosophy", "Smith, John", 2024, "10.1", "J", "1", "2", "1--25", "Academic Press")
    pairs = spark.createDataFrame([(1, a, a), (2, a, ("Errata for Introduction to Philosophy", "Doe", 2023, None, None, None, None, "1--9", None)), (3, a, ("", "x", None, None, None, None, None, None, None))], f"i int, s {side}, c {side}")
    legacy = {r.i: r for r in comparators.compare_legacy(pairs).collect()}
    assert legacy[1].title_score == 200 and legacy[1].total_score == 500 and legacy[2].year_score == 100 and legacy[2].title_score < 50 and legacy[3].parsing_status == "error"
    detailed = {r.i: r for r in comparators.compare_detailed(pairs).collect()}
    assert [p.score for p in detailed[1].partial_scores] == [200, 200, 100, 180] and detailed[2].partial_scores[3].score == 20 and detailed[3].partial_scores[0].score == 0


def test_quality_on_small_numbers(spark):
    results = spark.createDataFrame([("RIGHT_KEY", 1), ("WRONG_KEY", 2), ("RIGHT_KEY", None), ("NOT_IN_BIBLIO", 1)], "annotation_type string, rank int")
    assert quality.retrieval(results).first().asDict() == pytest.approx({"precision_at_1": 1 / 3, "recall_at_5": 2 / 3, "mrr": 0.5})
    assert quality.retrieval(results.limit(0)).first().asDict() == {"precision_at_1": 0, "recall_at_5": 0, "mrr": 0}
    best = spark.createDataFrame([("a", float(x)) for x in (4, 1, 3, 2)], "annotation_type string, best_score double")
    assert quality.score_statistics(best).first()["median"] == 3.0


def test_command_line(spark, tmp_path):
    from quire import cli

    (tmp_path / "bib.csv").write_text('bibkey,title,author,date,doi\nk1,Introduction to Philosophy,"Smith, John",2024,10.1/x\nk2,Ethics,"Doe, Jane and Roe, Ann",2023,\n')
    (tmp_path / "in.csv").write_text('bibkey,title,author,date,doi\n,Ethics,"Doe, J.",2023,\n,Philosophy,"Smith, John",2024,10.1/x\n')
    cli.main(["match", "--input", str(tmp_path / "in.csv"), "--bibliography", str(tmp_path / "bib.csv"), "--output", str(tmp_path / "out"), "--top-n", "2", "--cache", str(tmp_path / "cache")])
    rows = {r.title: r for r in readers.read_csv(spark, str(tmp_path / "out")).collect()}
    assert rows["Ethics"].match_1_bibkey == "k2" and rows["Ethics"].match_1_full_entry == "Doe, Jane and Roe, Ann (2023). Ethics."
    assert rows["Philosophy"].match_1_bibkey == "k1" and rows["Philosophy"].match_2_bibkey == ""
