"""Sources: Parquet, delimited text, JSON, XML, workbooks, HTML pages, archives and gazettes, all read in parallel."""

from __future__ import annotations

import io
import re
import zipfile
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS, SEPARATORS = ("UTF-8", "ISO-8859-1"), (";", ",", "\t", "|", "§")


def parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Files or folders; columns are pruned in the scan."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


HEAD = 1 << 16


def heads(spark: SparkSession, path: str) -> dict[str, bytes]:
    """The first HEAD bytes of each file, in the order of their names; no file is read further."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    out, found = {}, fs.listFiles(folder, True)
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            stream = fs.open(file)
            out[file.toString()] = bytes(stream.readNBytes(HEAD))
            stream.close()
    return dict(sorted(out.items()))


def sniff(head: bytes) -> tuple[str, str, tuple[str, ...]]:
    """Encoding, separator and header by a file's head: the first encoding that decodes, the separator with most columns in the first line."""
    encoding, text = ENCODINGS[1], head.decode("latin-1")
    try:
        encoding, text = ENCODINGS[0], head.decode("utf-8-sig")
    except UnicodeDecodeError as error:
        if len(head) == HEAD and error.start >= len(head) - 4:  # only the cut of the head is broken
            encoding, text = ENCODINGS[0], head[: error.start].decode("utf-8-sig")
    line = text.splitlines()[0] if text.splitlines() else ""
    separator = max(SEPARATORS, key=lambda s: (len(line.split(s)), -SEPARATORS.index(s)))
    return encoding, separator, _header(line, separator)


def _header(line: str, separator: str) -> tuple[str, ...]:
    names = [c.strip().strip('"') for c in line.split(separator)]
    return tuple(n or f"unnamed:_{i}" for i, n in enumerate(names))


def delimited(spark: SparkSession, path: str, separator: str | None = None, encoding: str | None = None) -> DataFrame:
    """All columns text; lines with too many fields, empty ones too, are left out, those with too few end in nulls. Each file is read by its own encoding, separator and header; files alike in these are read together, and columns that a file hasn't got are null."""
    alike: dict[tuple, list[str]] = {}
    for file, head in heads(spark, path).items():
        own_encoding, own_separator, names = sniff(head)
        if separator and separator != own_separator:
            names = _header(head.decode(encoding or own_encoding, "replace").removeprefix("\ufeff").splitlines()[0] if head else "", separator)
        alike.setdefault((encoding or own_encoding, separator or own_separator, names), []).append(file)
    frames = [_alike(spark, files, *of) for of, files in alike.items() if of[2] != ("unnamed:_0",)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else spark.createDataFrame([], T.StructType([]))


def _alike(spark: SparkSession, files: list[str], encoding: str, separator: str, names: tuple[str, ...]) -> DataFrame:
    schema = T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(len(names))], T.StructField("line", T.StringType())])
    reader = spark.read.schema(schema).option("encoding", encoding).option("sep", separator).option("header", "true").option("enforceSchema", "true")
    # a line whose fields aren't as many as the names is told whole; it is too long if it has more separators outside quotes
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line").option("columnPruning", "false").csv(files)
    bare = F.regexp_replace("line", '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
    return rows.where(F.col("line").isNull() | (fields <= len(names))).drop("line").toDF(*names)


def json_pages(spark: SparkSession, path: str, items: str = "items") -> DataFrame:
    """Pages of items, one row an item."""
    return spark.read.option("multiLine", "true").json(path).select(F.explode(items).alias("item")).select("item.*")


def json_any(spark: SparkSession, path: str, keys: tuple[str, ...] = ("items", "data", "results", "records", "value", "rows")) -> DataFrame:
    """One variant a record, whether a file is a list, an object with a list under one of the keys, or an object of objects."""
    whole = spark.read.option("wholetext", "true").text(path).select(F.try_parse_json("value").alias("v"))
    lists = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), *[F.try_variant_get("v", f"$.{k}", "array<variant>") for k in keys], F.map_values(F.try_variant_get("v", "$", "map<string,variant>")))
    return whole.select(F.explode(lists).alias("record"))


def unzipped(files: DataFrame, member: str = r"\.(atom|xml)$") -> DataFrame:
    """(archive, member, content) of the matching members of ZIP archives (path, content); one archive at a time in a worker."""

    def unzip(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for m in z.namelist():
                            if re.search(member, m, re.IGNORECASE):
                                yield pa.RecordBatch.from_pydict({"archive": [name], "member": [m], "content": pa.array([z.read(m).decode("utf-8", "replace")])})
                except zipfile.BadZipFile:
                    continue  # files that only end like an archive

    return files.select("path", "content").mapInArrow(unzip, "archive string, member string, content string")


def archives(spark: SparkSession, path: str, member: str = r"\.(atom|xml)$") -> DataFrame:
    """The matching members of all ZIP archives under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return unzipped(valid_files(files), member)


def xml_entries(spark: SparkSession, path: str, schema: T.StructType | None = None, tag: str = "entry") -> DataFrame:
    """Entries of feeds by Spark's own XML source."""
    reader = spark.read.format("xml").option("rowTag", tag)
    return (reader.schema(schema) if schema else reader).load(path)


def valid_files(files: DataFrame, least: int = 100) -> DataFrame:
    """Files that aren't too small, begin like an archive, workbook, JSON or PDF, and aren't a page that tells of an error."""
    head = F.hex(F.substring("content", 1, 4))
    known = head.startswith("504B0304") | head.startswith("D0CF11E0") | head.startswith("7B") | head.startswith("5B") | head.startswith("25504446")
    page = F.lower(F.decode(F.substring("content", 1, 512), "ISO-8859-1")).rlike(r"^\s*(?:<!doctype html|<html)")
    return files.where((F.col("length") >= least) & known & ~page)


def gazettes(spark: SparkSession, path: str, name: str = "BORME-A-*.pdf.txt") -> DataFrame:
    """(path, text) of the gazettes' extracted text under a folder, one file a row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.decode("content", "UTF-8").alias("text"))


def by_keys(state: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The state's rows of the wanted keys, by one join."""
    return state.join(wanted.select(*keys).distinct(), keys, "left_semi")


def sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """N random rows, the same ones for a seed and the same partitions."""
    return df.orderBy(F.rand(seed)).limit(n)


def workbook_rows(content: bytes) -> list[list[str | None]]:
    """The first sheet's cells as text, by the standard library alone."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheets = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        rows = []
        for row in ElementTree.fromstring(z.read(sheets[0])).iter(f"{{{ns['m']}}}row") if sheets else ():
            cells: dict[int, str | None] = {}
            last = 0
            for c in row.findall("m:c", ns):
                at = 0
                for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
                    at = at * 26 + ord(letter) - 64
                at = last = at or last + 1  # a cell without a reference follows the one before
                v = c.find("m:v", ns)
                if c.get("t") == "s" and v is not None:
                    cells[at - 1] = shared[int(v.text)]
                elif c.get("t") == "inlineStr":
                    cells[at - 1] = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                else:
                    cells[at - 1] = v.text if v is not None else None
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return rows


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, cells) of the first sheets of the workbooks; broken or empty ones give no rows."""

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows = workbook_rows(content)
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError):
                    continue
                if rows:
                    yield pa.RecordBatch.from_pydict({"path": pa.array([name] * len(rows)), "row": pa.array(range(len(rows)), pa.int32()), "cells": pa.array(rows, pa.list_(pa.string()))})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, "path string, row int, cells array<string>")


class _Page(HTMLParser):
    """Pairs of dt and dd, and tables with their header and rows."""

    def __init__(self):
        super().__init__()
        self.pairs, self.tables, self._term, self._said, self._cell, self._row = [], [], None, None, None, None
        self.title, self._title = "", False

    def handle_starttag(self, tag, attrs):
        if tag in ("dt", "dd"):
            self._said = []
        elif tag == "title":
            self._title = True
        elif tag == "table":
            self.tables.append({"header": [], "rows": []})
        elif tag == "tr" and self.tables:
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []

    def handle_endtag(self, tag):
        if tag in ("dt", "dd") and self._said is not None:
            said = " ".join("".join(self._said).split())
            if tag == "dt":
                self._term = said
            elif self._term is not None:
                self.pairs.append({"label": self._term, "value": said})
            self._said = None
        elif tag == "title":
            self.title, self._title = " ".join(self.title.split()), False
        elif tag in ("td", "th") and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
            if tag == "th":
                self.tables[-1]["header"].append(self._row.pop())
        elif tag == "tr" and self._row is not None:
            if any(self._row):
                self.tables[-1]["rows"].append(self._row)
            self._row = None

    def handle_data(self, data):
        if self._title:
            self.title += data
        for part in (self._cell, self._said):
            if part is not None:
                part.append(data)


PAGE = "title string, pairs array<struct<label: string, value: string>>, tables array<struct<header: array<string>, rows: array<array<string>>>>"


def html_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """A page's labelled values and tables."""

    def parse(batches):
        kind = pa.struct([("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))])
        for batch in batches:
            done = []
            for text in batch.column(html).to_pylist():
                page = _Page()
                page.feed(text or "")
                page.close()
                done.append(page)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([p.title for p in done], pa.string()), pa.array([p.pairs for p in done], pa.list_(pa.struct([("label", pa.string()), ("value", pa.string())]))), pa.array([p.tables for p in done], pa.list_(kind))], names=[key, "title", "pairs", "tables"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, F.col(html).cast("string").alias(html)).mapInArrow(parse, f"`{key}` {kind}, {PAGE}")


def labelled(pairs: Column, labels: dict[str, str], normalise) -> dict[str, Column]:
    """A column for each label's name, of the first pair with that label."""
    own = F.transform(pairs, lambda p: F.struct(normalise(p["label"]).alias("label"), p["value"].alias("value")))

    def value(label: str) -> Column:
        return F.get(F.filter(own, lambda p: p["label"] == F.lit(label)), F.lit(0))["value"]

    return {name: value(label) for label, name in labels.items()}


def table_rows(tables: Column, header: list[str]) -> Column:
    """The rows of the tables with this header."""
    return F.flatten(F.transform(F.filter(tables, lambda t: t["header"] == F.array(*[F.lit(h) for h in header])), lambda t: t["rows"]))


def party_id(ids: Column, scheme: str) -> Column:
    """The last identifier of a scheme in an array of (_VALUE, _schemeName)."""
    own = F.filter(ids, lambda i: i["_schemeName"] == F.lit(scheme))
    return F.get(own, F.size(own) - 1)["_VALUE"]


def parent_chain(levels: list[Column]) -> Column:
    """Names of nested parents, the outermost first, as A > B > C; levels: from the innermost, null where there is none."""
    return F.array_join(F.reverse(F.filter(F.array(*levels), lambda x: x.isNotNull())), " > ")
