"""Queries over files, streams and layouts: each writes the driver's tables in some form and reads them back.

Oracles are written from the tables alone.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.functions import text, values
from contrata.operators import reshape
from contrata.operators.cut import shared_folder
from contrata.plans import consolidation
from contrata.plans.driver import table
from contrata.plans.registry import register
from contrata.sources import feeds, layouts, readers, sinks
from contrata.streaming import incremental


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _archives(rows: DataFrame) -> DataFrame:
    """(path, content): a ZIP archive for each batch of rows, with one feed of their entries and a note, and a broken archive beside it."""

    def packed(batches):
        for batch in batches:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("feed.ATOM", "<feed>" + "".join(batch.column("entry").to_pylist()) + "</feed>")
                z.writestr("note.txt", "<feed><entry><id>none</id></entry></feed>")
            yield pa.RecordBatch.from_pydict({"path": ["a.zip", "broken.zip"], "content": pa.array([out.getvalue(), b"PK\x03\x04" + b"x" * 200], pa.binary())})

    return rows.mapInArrow(packed, "path string, content binary")


@register("s12_archives", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS expediente, 'Resuelta' AS estado FROM customer")
def s12(spark, sf_dir):
    """Feeds in archives, members of other names and broken archives passed over."""
    status = F.concat(F.lit("<cac-place-ext:ContractFolderStatus><cbc:ContractFolderID>"), F.col("c_name"), F.lit("</cbc:ContractFolderID><cbc-place-ext:ContractFolderStatusCode>RES</cbc-place-ext:ContractFolderStatusCode></cac-place-ext:ContractFolderStatus>"))
    entry = F.concat(F.lit("<entry><id>"), F.col("c_custkey").cast("string"), F.lit("</id>"), status, F.lit("</entry>"))
    files = readers.unzipped(_archives(table(spark, sf_dir, "customer").select(entry.alias("entry"))))
    return feeds.contract_records(feeds.entries(files)).select("id", "expediente", "estado")


@register("k5_workbook", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CASE WHEN n_nationkey % 3 > 0 THEN CAST(n_regionkey AS VARCHAR) || ' <&' END AS region FROM nation")
def k5(spark, sf_dir):
    """Nations as a workbook, empty cells and signs of XML among them, read back beside a broken one."""
    folder, key = _folder(spark), F.col("n_nationkey")
    sinks.workbook(table(spark, sf_dir, "nation").select(key.alias("id"), F.col("n_name").alias("name"), F.when(key % 3 > 0, F.concat(F.col("n_regionkey").cast("string"), F.lit(" <&"))).alias("region")), f"{folder}/nations.xlsx")
    rows = readers.workbooks(spark, folder).where("row > 0")
    return rows.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(("id", "name", "region"))])


@register("s13_gazettes", "SELECT n_nationkey AS id, n_name || ' SL' AS company, 'PROVINCIA ' || CAST(n_regionkey AS VARCHAR) AS province FROM nation")
def s13(spark, sf_dir):
    """One text file a gazette, found by its name under a folder, and its lines."""
    folder = _folder(spark)
    line = F.concat(F.col("n_nationkey").cast("string"), F.lit("|"), F.col("n_name"), F.lit(" SL|PROVINCIA "), F.col("n_regionkey").cast("string"))
    table(spark, sf_dir, "nation").select("n_regionkey", line.alias("value")).repartition(1).write.partitionBy("n_regionkey").text(folder)
    lines = readers.gazettes(spark, folder, "part-*.txt").select(F.explode(F.split("text", "\n")).alias("line")).where("line != ''")
    of = F.split("line", r"\|")
    return lines.select(of[0].cast("int").alias("id"), of[1].alias("company"), of[2].alias("province"))


@register("st_upsert", "SELECT o_custkey, arg_max(o_orderstatus, (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey)) AS o_orderstatus, arg_max(o_orderkey, (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1")
def st_upsert(spark, sf_dir):
    """K9, A2, streaming: files that arrive in two runs of one query, each file read once, keyed state kept in versions."""
    folder, rows = _folder(spark), table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    for n, status in enumerate("OF"):
        rows.where(F.col("o_orderstatus") == status).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = incremental.new_files(spark, f"{folder}/in", rows.schema)
        incremental.run_once(stream, f"{folder}/seen", incremental.upsert_into(f"{folder}/state", ["o_custkey"], "o_orderkey"))
    return spark.read.parquet(f"{folder}/state/v={n}").select("o_custkey", "o_orderstatus", "o_orderkey")


@register("st_first_seen", "SELECT DISTINCT o_custkey FROM orders")
def st_first_seen(spark, sf_dir):
    """D-4, A3 as a stream: each key once, whatever files it comes in."""
    folder = _folder(spark)
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    rows.write.parquet(f"{folder}/in")
    first = incremental.first_seen(incremental.new_files(spark, f"{folder}/in", rows.schema), ["o_custkey"], "at", "100000 days")
    incremental.run_once(first, f"{folder}/seen", lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/v={n}"))
    return spark.read.parquet(f"{folder}/out").select("o_custkey")


@register("n4_buyer_key", "SELECT c_custkey, 'ALCALDIA PENA UNO DE ' || trim(regexp_replace(upper(c_name), '[^A-Z0-9]+', ' ', 'g')) AS buyer, CAST(date_diff('day', DATE '2020-01-31', DATE '2020-01-31' + CAST(c_custkey % 400 AS INT)) AS INT) AS days, CAST(c_custkey AS VARCHAR) AS id, sha256(c_name) AS digest FROM customer")
def n4(spark, sf_dir):
    """N4, T5f, C10, C12."""
    key = F.col("c_custkey")
    name = F.concat(F.lit(" Alcaldía; (Peña) [uno]  de "), F.translate(F.col("c_name"), "#", "-"))
    start = F.lit("2020-01-31").cast("date")
    return table(spark, sf_dir, "customer").select(key, text.buyer_key(name).alias("buyer"), values.days_between(F.date_add(start, (key % 400).cast("int")), start).alias("days"), text.record_id(F.concat(F.lit(" "), key.cast("string"), F.lit(".0 "))).alias("id"), F.sha2(F.col("c_name").cast("binary"), 256).alias("digest"))


@register("f9_patterns", "SELECT o_orderkey, o_orderkey % 4 = 0 AS health FROM orders WHERE o_orderkey % 5 > 0")
def f9(spark, sf_dir):
    """buyers told by patterns in either case, cancelled notices left out."""
    buyer = F.element_at(F.array(*map(F.lit, ["Gerencia del HOSPITAL de Jaca", "Ayuntamiento de Jaca", "Hospitalet Promocions", "Universidad"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", buyer.alias("buyer"), F.when(F.col("o_orderkey") % 5 == 0, "1").when(F.col("o_orderkey") % 5 == 1, "0").alias("cancelled"))
    return feeds.not_cancelled(rows).select("o_orderkey", text.matches_any(F.col("buyer"), [r"\bhospital\b", "servicio .* salud"]).alias("health"))


@register("p12_names", "SELECT c_custkey AS id, c_name AS name FROM customer")
def p12(spark, sf_dir):
    """Old names to new ones, of columns that so share a name the first."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("old_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"))
    return reshape.first_of_names(rows.withColumnsRenamed({"old_id": "id", "title": "name"}))


_HEADERS = {"a": ["N. Expediente", "Importe adjudicaci¢n IVA", "Importe adjudicaci¢n", "Objeto del contrato"], "b": ["tipo", "fecha"], "c": ["Objeto", "N._EXPEDIENTE"]}


@register("p15_layouts", "SELECT * FROM (VALUES ('a', 'N. Expediente', 'expediente'), ('a', 'Importe adjudicaci¢n IVA', 'importe_con_iva'), ('a', 'Importe adjudicaci¢n', 'importe'), ('a', 'Objeto del contrato', 'objeto'), ('c', 'Objeto', 'objeto'), ('c', 'N._EXPEDIENTE', 'expediente'), ('rows', '1', ''), ('none', 'tipo', 'unnamed:_1'), ('first', 'fecha', 'tipo'), ('layout', 'b', '')) AS m(source, header, name)")
def p15(spark, sf_dir):
    """Headers mapped by names, patterns and words, a header found below a title, files without one, layouts told apart; all from headers, on the driver."""
    keywords = {"objeto": [("objeto",), ("objeto", "contrato")], "importe": [("importe",)]}
    patterns = [("importe.*iva", "importe_con_iva"), ("importe.*adjudicación", "importe")]
    told = [(source, h, name) for source, header in _HEADERS.items() for h, name in consolidation.mapped(header, {"n. expediente": "expediente"}, keywords, patterns).items()]
    told.append(("rows", str(layouts.header_row([["Contratos menores 2020", "", ""], ["tipo", "fecha", "importe"], ["a", "b", "3"]])), ""))
    told.append(("none", "tipo", layouts.positional(["x", "y"], [(r"^[0-9]{2}/", ["fecha", "tipo"])])[1]))
    told.append(("first", *layouts.positional(["01/02/2020", "y"], [(r"^[0-9]{2}/", ["fecha", "tipo"])])))
    told.append(("layout", layouts.detect(_HEADERS["b"], {"a": ["tipo"], "b": ["Tipo", "FECHA"], "c": ["tipo", "objeto"]}), ""))
    return spark.createDataFrame(told, "source string, header string, name string")


@register("q15_consolidated", "SELECT 'EXP-' || CAST(o_orderkey AS VARCHAR) AS expediente, o_orderkey + 1234.5e0 AS importe, CASE WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS fecha, CASE WHEN o_orderstatus = 'F' THEN 'f' ELSE 'o' END AS source FROM orders WHERE o_orderstatus IN ('F', 'O')")
def q15(spark, sf_dir):
    """Q15: two regions' orders under headers and forms of their own, repeated and empty rows among them."""
    key, orders = F.col("o_orderkey"), table(spark, sf_dir, "orders")
    number = F.concat(F.lit("EXP-"), key.cast("string"))
    first = orders.where("o_orderstatus = 'F'").select(number.alias("Nº Expediente"), F.concat(F.translate(F.format_number(key + 1234.5, 2), ",.", ".,"), F.lit(" €")).alias("IMPORTE ADJUDICACIÓN"), F.when(key % 3 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("nan").alias("Fecha"))
    second = orders.where("o_orderstatus = 'O'").select(F.when(key % 3 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("fecha de formalización"), number.alias("expediente"), (key + 1234.5).alias("importe"), F.lit("x").alias("otros"))
    empty = first.sparkSession.createDataFrame([(" ", "None", "")], first.schema)
    frames = {"f": first.unionByName(first).unionByName(empty), "o": second.unionByName(second)}
    got = consolidation.consolidated(frames, ["expediente", "importe", "fecha", "objeto"], {"expediente": "expediente"}, {"expediente": [("expediente",)], "fecha": [("fecha",), ("fecha", "formalización")]}, [("importe", "importe")])
    return got.select("expediente", "importe", F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), "source")


@register("a1_periods", "SELECT CAST(y AS VARCHAR) || coalesce(lpad(CAST(m AS VARCHAR), 2, '0'), '') AS period FROM (SELECT DISTINCT year(o_orderdate) AS y, CASE WHEN year(o_orderdate) >= 1996 THEN month(o_orderdate) END AS m FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5)")
def a1(spark, sf_dir):
    """The periods that have a workday's orders, years first and months from a year on."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").where(F.weekday(day) < 5).select(values.period(day, 1996).alias("period")).distinct()
