"""Batch sources: CSV, JSON, text lists, spreadsheets and documents in zipped XML, and works of a web API."""

from __future__ import annotations

import io
import itertools
import time
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition
from pyspark.sql.window import Window

TABLE, TEXT, OFFICE = ("{urn:oasis:names:tc:opendocument:xmlns:%s:1.0}" % x for x in ("table", "text", "office"))
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, blanks kept as ''."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').fillna("")


def with_row_id(rows: DataFrame) -> DataFrame:
    """Dense numbers from 0 in the order of the files: counted by partition, so that no task sees all rows."""
    marked = rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    sizes = marked.groupBy("_part").count()
    before = sizes.withColumn("_before", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    return marked.join(F.broadcast(before), "_part").withColumn("row_id", F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)).drop("_part", "_at", "_before")


def with_temporary_keys(rows: DataFrame, key: str = "bibkey") -> DataFrame:
    """Rows without a key get 'temp:' and the number of their line, the header being the first."""
    numbered = with_row_id(rows)
    return numbered.withColumn(key, F.when(F.coalesce(F.trim(key), F.lit("")) == "", F.concat(F.lit("temp:"), (F.col("row_id") + 2).cast("string"))).otherwise(F.col(key)))


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Records of a CSV or ODS file by its suffix; any other is a ValueError."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in (".csv", ".ods"):
        raise ValueError(f"neither .csv nor .ods: {path}")
    return with_temporary_keys(read_csv(spark, path) if suffix == ".csv" else read_ods(spark, path))


def read_urls(spark: SparkSession, path: str, *more: str) -> DataFrame:
    """url: trimmed lines that aren't blank, and those given."""
    listed = spark.read.text(path).select(F.trim("value").alias("url")).where(F.col("url") != "")
    return listed.unionByName(spark.createDataFrame([(u,) for u in more], "url string")) if more else listed


def sheet_rows(raw: bytes) -> Iterator[list[str]]:
    """Cells of the first sheet of an ODS file as text, repeated ones spelt out, empty rows left out."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        sheet = ElementTree.fromstring(z.read("content.xml")).find(f".//{TABLE}table")
    for row in sheet.iter(f"{TABLE}table-row"):
        cells: list[str] = []
        for cell in row:
            text = "\n".join("".join(p.itertext()) for p in cell.findall(f"{TEXT}p"))
            cells += [text or cell.get(f"{OFFICE}value", "")] * int(cell.get(f"{TABLE}number-columns-repeated", 1))
        while cells and not cells[-1]:
            cells.pop()
        if cells:
            yield from itertools.repeat(cells, int(row.get(f"{TABLE}number-rows-repeated", 1)))


def read_ods(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of spreadsheets with the same header; each file is read by one task, which for the first one gives its header to the driver. Cells beyond the header are an error."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([next(sheet_rows(raw), [])], pa.list_(pa.string()))], ["header"])

    header = list(files.limit(1).mapInArrow(heads, "header array<string>").first().header)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                table = [r for i, r in enumerate(sheet_rows(raw)) if i]
                if max(map(len, table), default=0) > len(header):
                    raise ValueError("a row of the spreadsheet has more cells than the header")
                yield pa.RecordBatch.from_arrays([pa.array([r[k] if k < len(r) else "" for r in table], pa.string()) for k in range(len(header))], header)

    return files.mapInArrow(rows, ", ".join(f"`{c}` string" for c in header))


def read_bibliography(spark: SparkSession, path: str) -> DataFrame:
    """Records of an ODS or CSV file, one for each bibkey: the last."""
    rows = read_staged(spark, path)
    return rows.groupBy("bibkey").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "bibkey"]), "row_id").alias("r")).select("bibkey", "r.*")


def paragraphs(raw: bytes) -> str:
    """Text of a docx file's paragraphs, blank ones left out."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    texts = ("".join(t.text or "" for t in p.iter(f"{WORD}t")) for p in body.iter(f"{WORD}p"))
    return "\n".join(t for t in texts if t.strip())


def page_texts(raw: bytes) -> str:
    """Text of a PDF file's pages, if a library for it is installed."""
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise ImportError("reading PDF needs the package pypdf") from e
    return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(raw)).pages)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, text, parsing_status and message of docx and PDF files; a file that can't be read is an error row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"path": [], "text": [], "parsing_status": [], "message": []}
            for name, raw in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    row = (name, (page_texts if name.lower().endswith(".pdf") else paragraphs)(raw), "success", "")
                except Exception as e:  # noqa: BLE001  any fault of a file is its row's
                    row = (name, None, "error", f"{type(e).__name__}: {e}")
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out.values()], list(out))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, "path string, text string, parsing_status string, message string")


class Year(InputPartition):
    def __init__(self, value: int) -> None:
        super().__init__(value)
        self.year = value


class WorksReader(DataSourceReader):
    """One partition for each year; an equality on year prunes the others."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.years = range(int(options.get("from", 0)), int(options.get("until", -1)) + 1)

    def pushFilters(self, filters):  # noqa: N802  the interface's name
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("year",):
                self.years = [y for y in self.years if y == f.value]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Year(0)] if "doi" in self.options else [Year(y) for y in self.years]

    def read(self, partition: Year) -> Iterator[tuple]:
        import json
        import urllib.parse
        import urllib.request

        base, agent = self.options["base"].rstrip("/"), self.options.get("agent", "quire")

        def get(path: str, **query: str) -> dict:
            url = f"{base}/{path}" + ("?" + urllib.parse.urlencode(query) if query else "")
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=float(self.options.get("timeout", 30))) as r:  # noqa: S310
                return json.load(r)["message"]

        if "doi" in self.options:
            yield (None, json.dumps(get("works/" + urllib.parse.quote(self.options["doi"], safe=""))))
            return
        year, cursor = partition.year, "*"
        while True:  # by cursor, so that years with over a thousand works are whole
            page = get(f"journals/{self.options['issn']}/works", filter=f"from-pub-date:{year},until-pub-date:{year}", rows="1000", cursor=cursor)
            for item in page["items"]:
                yield (year, json.dumps(item))
            cursor = page.get("next-cursor")
            if len(page["items"]) < 1000 or not cursor:
                return
            time.sleep(float(self.options.get("pause", 0.1)))


class Works(DataSource):
    """Works of a journal by year, or one by DOI, as JSON text: options base, issn, from, until, doi, timeout, pause, agent."""

    @classmethod
    def name(cls) -> str:
        return "works"

    def schema(self) -> str:
        return "year int, raw string"

    def reader(self, schema) -> DataSourceReader:
        return WorksReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source `works` known. Its reader prunes years by a filter, which Spark offers to it only if told so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Works)


def journal_title(base: str, issn: str, timeout: float = 30) -> str | None:
    import json
    import urllib.request

    with urllib.request.urlopen(f"{base.rstrip('/')}/journals/{issn}", timeout=timeout) as r:  # noqa: S310
        return json.load(r)["message"].get("title")


def reachable(base: str, timeout: float = 10) -> bool:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(base, timeout=timeout) as r:  # noqa: S310
            return r.status < 500
    except (urllib.error.URLError, OSError):
        return False


def download(url: str, path: str, timeout: float = 60) -> str:
    """Saves url under path, to be read by Spark from there."""
    import urllib.request

    with urllib.request.urlopen(url, timeout=timeout) as r, open(path, "wb") as f:  # noqa: S310
        f.write(r.read())
    return path


def bib_name(name: str) -> str:
    return name if name.endswith(".bib") else f"{name}.bib"


def fetch(urls: DataFrame, timeout: float = 30, pause: float = 1.0, get=None) -> DataFrame:
    """url, html, parsing_status, message of each row of urls, at most one request a `pause` from each task. get: url to text, for tests and other protocols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import urllib.request

        def default(url: str) -> str:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")

        for batch in batches:
            for url in batch.column(0).to_pylist():
                try:
                    row = (url, (get or default)(url), "success", "")
                except Exception as e:  # noqa: BLE001  a page's fault is its row's
                    row = (url, None, "error", f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in row], ["url", "html", "parsing_status", "message"])
                time.sleep(pause)

    return urls.select("url").mapInArrow(run, "url string, html string, parsing_status string, message string")


def ask_model(texts: DataFrame, client, column: str = "text", batch: int = 16) -> DataFrame:
    """texts with answer, parsing_status and message: client maps a text to JSON text and is made anew in each task by calling client()."""
    kept = texts.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = client()
        for b in batches:
            answers, status, message = [], [], []
            for text in b.column(column).to_pylist():
                try:
                    answers.append(ask(text)), status.append("success"), message.append("")
                except Exception as e:  # noqa: BLE001  an answer's fault is its row's
                    answers.append(None), status.append("error"), message.append(f"{type(e).__name__}: {e} | {(text or '')[:500]}")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(answers, pa.string()), pa.array(status), pa.array(message)], [*b.schema.names, "answer", "parsing_status", "message"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return texts.mapInArrow(run, f"{fields}, answer string, parsing_status string, message string")
