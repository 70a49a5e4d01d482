"""Sinks: Parquet, delimited text, split output, samples, keyed state and manifests."""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.operators import dedupe, reshape


def parquet(df: DataFrame, path: str, by: list[str] | None = None, drop_empty: bool = False) -> None:
    """K1, K4, K8: Parquet, split by columns if there are some, without columns that are null throughout if asked for."""
    writer = (reshape.without_empty_columns(df) if drop_empty else df).write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def delimited(df: DataFrame, path: str, separator: str = ";", compression: str = "none") -> None:
    """K2, K6: delimited text in UTF-8 with a header in each part (Spark writes no byte-order mark)."""
    df.write.mode("overwrite").option("sep", separator).option("header", "true").option("compression", compression).csv(path)


def append(df: DataFrame, path: str, columns: list[str]) -> None:
    """Appended Parquet of a fixed schema, whatever columns come in."""
    reshape.canonical(df, columns, {}).write.mode("append").parquet(path)


def head(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """K6, O3: the first rows in an order."""
    return df.orderBy(*order).limit(n)


def upsert(state: DataFrame | None, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """K9: state with the batch's rows in place of those of the same keys; of several, the last in order. The result is written elsewhere and takes the state's place, as files aren't changed while they are read."""
    rows = batch.withColumn("__new", F.lit(1))
    if state is not None:
        rows = rows.unionByName(state.withColumn("__new", F.lit(0)), allowMissingColumns=True)
    return dedupe.one_per_key(rows, keys, [F.col("__new"), F.col(order)], last=True).drop("__new")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and SHA-256 of files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


#: Fixed value: rows of a sheet, its header among them.
SHEET_ROWS = 1_048_576

_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="datos" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def _row(cells: list[str | None]) -> str:
    said = (re.sub(r"[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]", "", c) if c is not None else None for c in cells)
    return "<row>" + "".join("<c/>" if c is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for c in said) + "</row>"


def _sheet(names: list[str], batches) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for part, said in _PARTS.items():
            z.writestr(part, said)
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{_row(names)}'.encode())
            for batch in batches:
                for cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    sheet.write(_row(list(cells)).encode())
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def workbook(df: DataFrame, path: str) -> bool:
    """K5: one workbook of text cells, if the rows fit into a sheet (told by a count that stops there); else nothing is written. One task makes the file, the driver stores it."""
    if df.limit(SHEET_ROWS).count() >= SHEET_ROWS:
        return False
    names = df.columns

    def made(batches):
        yield pa.RecordBatch.from_pydict({"content": pa.array([_sheet(names, batches)], pa.binary())})

    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(names)])
    content = rows.coalesce(1).mapInArrow(made, "content binary").first()
    spark = df.sparkSession
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file, True)
    stream.write(bytearray(content["content"] if content else _sheet(names, [])))
    stream.close()
    return True


def summary(df: DataFrame) -> DataFrame:
    """K7: per column, its type and the values that aren't null; one aggregation."""
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("n_values")) for c, t in df.dtypes])
    return counts.select(F.col("__rows").alias("rows"), F.explode(pairs).alias("c")).select("c.*", "rows")
