"""One query for each operator of this subpackage, over whole tables, and the oracle SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.llm import audio, chat, contamination, kneser, licenses, lines, minhash, packing, secret_scan, urltree
from contrata.llm.common import table

URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    """Where the tokenizer's file is; it is installed with every Python of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audio_digest(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_kept").alias("n_kept"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    return chat.digests(chat.format_records(chat.records_of(rows)))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is the quality of the document that its path names."""
    pages = table(spark, sf_dir, "pages")
    document = F.regexp_extract(urltree.path_of(F.col("url")), r"/([0-9]{1,18})", 1)
    named = pages.select("page_id", F.nullif(document, F.lit("")).cast("long").alias("doc_id")).where("doc_id is not null")
    quality = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good"))
    return urltree.url_verdicts(pages, named.join(quality, "doc_id").select("page_id", "good"), URL_RULES).drop("purity")


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = f"""
WITH line AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
place AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM line),
words AS (SELECT *, len(regexp_extract_all(lines[p], '{lines.WORD}')) AS n, len(regexp_extract_all(coalesce(lines[p + 1], ''), '{lines.WORD}')) AS m FROM place),
win AS (SELECT doc_id, p, 3 AS w, lines[p] AS a, lines[p + 1] AS b, lines[p + 2] AS c FROM words WHERE p + 2 <= len(lines) AND length(trim(lines[p] || lines[p + 1] || lines[p + 2], ' ')) > 0
UNION ALL SELECT doc_id, p, 1, lines[p], '', '' FROM words WHERE n > 50
UNION ALL SELECT doc_id, p, 2, lines[p], lines[p + 1], '' FROM words WHERE n <= 50 AND m <= 50 AND n + m > 50),
later AS (SELECT doc_id, p, w, row_number() OVER (PARTITION BY w, a, b, c ORDER BY doc_id, p) AS k FROM win),
gone AS (SELECT DISTINCT doc_id, p + j AS p FROM later, (VALUES (0), (1), (2)) AS o(j) WHERE k > 1 AND j < w),
single AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM line),
kept AS (SELECT s.doc_id, s.p, s.lines[s.p] AS t FROM single s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p WHERE g.p IS NULL),
text AS (SELECT doc_id, count(*) AS n, string_agg(t, chr(10) ORDER BY p) AS t FROM kept GROUP BY 1)
SELECT line.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_kept, sha256(coalesce(t, '')) AS kept_sha256
FROM line LEFT JOIN text USING (doc_id)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_minhash, op2_audio, op3_licenses, op4_quality, op5_packing, op6_lines, op7_chat, op8_secrets, op9_urls, op10_contamination]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_licenses": licenses.oracle(), "op6_lines": OP6_SQL}
