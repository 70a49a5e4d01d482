"""Queries over the driver's tables, in which orders stand for contracts, customers for companies and buyers.

The contract-shaped view is one SQL text that Spark and DuckDB read alike, so a query and its oracle begin from the same
rows; from there on the query goes through the operators, and the oracle through SQL of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.functions import fixed, identifiers, text, values
from contrata.operators import dedupe, graph, matching, reshape, windows
from contrata.plans import companies, coverage, quality
from contrata.plans.registry import register

CONTRACTS = """
SELECT o.o_orderkey AS id, o.o_orderkey AS row_ord, o.o_custkey AS buyer,
  concat('EXP-', CAST(o.o_custkey % 97 AS STRING), '-', CAST(o.o_orderkey % 400 AS STRING)) AS expediente,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE o.o_totalprice END AS importe_sin_iva,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE o.o_totalprice * (0.7 + (o.o_orderkey % 40) / 100.0e0) END AS importe_adjudicacion,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN 2.5e0 ELSE CAST(o.o_orderkey % 13 AS DOUBLE) END AS num_ofertas,
  o.o_orderdate AS fecha_publicacion, l.last_ship AS fecha_limite, CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE l.first_ship END AS fecha_adjudicacion,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'Obras' WHEN 1 THEN 'Servicios' WHEN 2 THEN 'Suministros' ELSE 'Privado' END AS tipo_contrato,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Adjudicada' WHEN 1 THEN 'Resuelta' ELSE 'Publicada' END AS estado,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 'Contrato menor' ELSE 'Abierto' END AS procedimiento,
  CASE WHEN o.o_orderkey % 10 = 0 THEN 'menores' WHEN o.o_orderkey % 41 = 0 THEN 'encargos' WHEN o.o_orderkey % 43 = 0 THEN 'consultas' ELSE 'licitaciones' END AS conjunto,
  CASE WHEN o.o_orderkey % 37 = 0 THEN 'CONSULTA' ELSE 'LICITACION' END AS tipo_registro,
  concat(CASE o.o_custkey % 9 WHEN 0 THEN 'Servicio Andaluz de Salud' WHEN 1 THEN 'Hospital Clinico de Madrid' WHEN 2 THEN 'Osakidetza' WHEN 3 THEN 'Ib.Salut Palma' WHEN 4 THEN 'Ayuntamiento de Sevilla' WHEN 5 THEN 'Universidad de Murcia' WHEN 6 THEN 'Consorcio Sanitario SERGAS' WHEN 7 THEN 'INGESA Ceuta' ELSE 'Diputacion Foral' END, ' ', CAST(o.o_custkey % 40 AS STRING)) AS organo_contratante,
  CASE WHEN o.o_orderkey % 31 = 0 THEN 'abc' ELSE concat(CAST(o.o_custkey % 9 AS STRING), '3', CAST(100000 + o.o_orderkey % 800000 AS STRING)) END AS cpv_principal,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'FR10' ELSE concat('es', CAST(o.o_custkey % 52 AS STRING)) END AS nuts,
  concat(lpad(CAST(o.o_custkey AS STRING), 8, '0'), substr('TRWAGMYFPDXBNJZSQVHLCKE', CAST((o.o_custkey + CASE WHEN o.o_orderkey % 6 = 0 THEN 1 ELSE 0 END) % 23 AS INT) + 1, 1)) AS nif_adjudicatario,
  concat(c.c_name, CASE o.o_orderkey % 3 WHEN 0 THEN ', S.L.U.' WHEN 1 THEN ' S.A.' ELSE ' Sociedad Limitada' END) AS adjudicatario,
  concat(CASE o.o_custkey % 5 WHEN 0 THEN 'Ministerio ' WHEN 1 THEN 'ADIF ' WHEN 2 THEN 'Metro de ' ELSE 'Concello ' END, c.c_mktsegment) AS dependencia,
  CASE WHEN o.o_orderkey % 12 = 0 THEN NULL ELSE concat('http://x/', CAST(o.o_orderkey AS STRING)) END AS url,
  CAST(year(o.o_orderdate) AS INT) + 20 AS ano
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""
CONTRACTS_SQL = CONTRACTS.format(orders="orders", customer="customer", lineitem="lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CONTRACTS, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"), lineitem=table(spark, sf_dir, "lineitem"))


def _nif_sql(x: str) -> str:
    digits = "+".join(f"CAST(substr({x}, {i}, 1) AS INT)" for i in (3, 5, 7))
    doubled = "+".join(f"(CASE WHEN CAST(substr({x}, {i}, 1) AS INT) >= 5 THEN CAST(substr({x}, {i}, 1) AS INT) * 2 - 9 ELSE CAST(substr({x}, {i}, 1) AS INT) * 2 END)" for i in (2, 4, 6, 8))
    control = f"((10 - ({digits} + {doubled}) % 10) % 10)"
    letter = f"substr('JABCDEFGHI', {control} + 1, 1)"
    person = f"substr('{fixed.PERSON_LETTERS}', CAST(CAST(substr({x}, 1, 8) AS INT) % 23 AS INT) + 1, 1)"
    foreign = f"substr('{fixed.PERSON_LETTERS}', CAST(CAST(translate(substr({x}, 1, 1), 'XYZ', '012') || substr({x}, 2, 7) AS INT) % 23 AS INT) + 1, 1)"
    last = f"substr({x}, 9, 1)"
    return f"""(CASE WHEN {x} IS NULL THEN false WHEN regexp_matches({x}, '^[0-9]{{8}}[A-Z]$') THEN {last} = {person}
      WHEN regexp_matches({x}, '^[XYZ][0-9]{{7}}[A-Z]$') THEN {last} = {foreign}
      WHEN regexp_matches({x}, '^[PQS][0-9]{{7}}[A-Z0-9]$') THEN {last} = {letter} WHEN regexp_matches({x}, '^[ABEH][0-9]{{7}}[A-Z0-9]$') THEN {last} = CAST({control} AS VARCHAR)
      WHEN regexp_matches({x}, '^[CDFGJNRUVW][0-9]{{7}}[A-Z0-9]$') THEN {last} = {letter} OR {last} = CAST({control} AS VARCHAR) ELSE false END)"""


_MINOR_SQL = "(conjunto = 'menores' OR procedimiento = 'Contrato menor')"
INDICATORS_SQL = f"""
WITH c AS ({CONTRACTS_SQL}), g AS (
  SELECT *, CASE WHEN cpv_principal = 'abc' THEN '' ELSE substr(cpv_principal, 1, 2) END AS dv FROM c),
p AS (SELECT *, quantile_cont(num_ofertas, 0.99) OVER (PARTITION BY dv) AS o99, quantile_cont(importe_adjudicacion, 0.01) OVER (PARTITION BY dv) AS a01, quantile_cont(importe_adjudicacion, 0.99) OVER (PARTITION BY dv) AS a99 FROM g),
i AS (SELECT *, importe_sin_iva IS NOT NULL AS val_01, importe_adjudicacion IS NOT NULL AS val_02,
  coalesce(importe_sin_iva >= 1, false) OR coalesce(importe_adjudicacion >= 1, false) OR (importe_sin_iva IS NULL AND importe_adjudicacion IS NULL) AS val_03,
  coalesce(num_ofertas = floor(num_ofertas), true) AS val_04, coalesce(num_ofertas >= 0, true) AS val_05,
  coalesce(fecha_publicacion BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31', false) AS val_06, coalesce(fecha_adjudicacion BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31', false) AS val_07,
  cpv_principal <> 'abc' AS val_09, nuts <> 'FR10' AS val_10, {_nif_sql("nif_adjudicatario")} AS val_12,
  NOT {_MINOR_SQL} OR importe_adjudicacion IS NULL OR importe_adjudicacion <= CASE WHEN tipo_contrato = 'Obras' THEN 40000 ELSE 15000 END AS val_14,
  estado = 'Publicada' OR coalesce(num_ofertas >= 1, false) AS cons_01,
  coalesce(NOT importe_sin_iva > 0 OR importe_adjudicacion <= importe_sin_iva * 1.05e0, true) AS cons_08,
  coalesce(num_ofertas BETWEEN 0 AND 500 AND num_ofertas <= coalesce(o99, 500), true) AS fia_01,
  coalesce(CAST(floor((epoch_us(fecha_limite) - epoch_us(fecha_publicacion)) / 86400000000.0) AS INT) BETWEEN 0 AND 365, true) AS fia_04,
  coalesce(importe_sin_iva <= 50000000, true) AS fia_08,
  CASE WHEN importe_adjudicacion > 0 THEN importe_adjudicacion BETWEEN a01 AND a99 ELSE true END AS fia_09, true AS fia_11, {_MINOR_SQL} AS es_menor FROM p)
"""
_ALL = quality.INDICATORS
_SCORE_SQL = f"round_even(({' + '.join(f'CAST({c} AS INT)' for c in _ALL)}) / {len(_ALL)}.0e0 * 100, 1)"


@register("q1_quality_indicators", INDICATORS_SQL + f"SELECT id, es_menor, {', '.join(_ALL)} FROM i")
def q1(spark, sf_dir):
    return quality.with_indicators(contracts(spark, sf_dir)).select("id", "es_menor", *_ALL)


@register("q3_quality_score", INDICATORS_SQL + f", s AS (SELECT tipo_contrato, {_SCORE_SQL} AS score FROM i) SELECT tipo_contrato, count(*) AS n, round(avg(score), 4) AS mean_score, min(score) AS least_score, max(score) AS most_score FROM s GROUP BY 1")
def q3(spark, sf_dir):
    scored = quality.with_score(quality.with_indicators(contracts(spark, sf_dir)), _ALL)
    return scored.groupBy("tipo_contrato").agg(F.count("*").alias("n"), F.round(F.avg("score_calidad"), 4).alias("mean_score"), F.min("score_calidad").alias("least_score"), F.max("score_calidad").alias("most_score"))


_REPORT_SQL = " UNION ALL ".join(f"SELECT '{c}' AS indicator, count(*) AS evaluated, count(*) FILTER (NOT {c}) AS failed, round_even(100.0e0 * count(*) FILTER (es_menor AND NOT {c}) / count(*) FILTER (es_menor), 1) AS failed_minor, round_even(100.0e0 * count(*) FILTER (NOT es_menor AND NOT {c}) / count(*) FILTER (NOT es_menor), 1) AS failed_other FROM i" for c in _ALL)


@register("g17_failure_report", INDICATORS_SQL + _REPORT_SQL)
def g17(spark, sf_dir):
    return quality.failure_report(quality.with_indicators(contracts(spark, sf_dir)), _ALL)


_IDS = "concat(substr('ABCDEFGHJKNPQRSUVWXYZ0123', CAST(c_custkey % 25 AS INT) + 1, 1), lpad(CAST((c_custkey * 7919) % 9999999 AS STRING), 7, '0'), substr('0123456789JABCDEFGHITRWGMYFPDXBNZSQVLCKE', CAST((c_custkey * 31) % 41 AS INT) + 1, 1))"


@register("v1_valid_nif", f"WITH x AS (SELECT c_custkey, {_IDS} AS nif FROM customer) SELECT c_custkey, nif, {_nif_sql('nif')} AS valid FROM x")
def v1(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_IDS).alias("nif"))
    return rows.select("c_custkey", "nif", identifiers.valid_nif(F.col("nif")).alias("valid"))


_CPV = "CASE p_partkey % 6 WHEN 0 THEN concat(CAST(p_partkey * 3001 AS STRING), '.0') WHEN 1 THEN concat(lpad(CAST(p_partkey AS STRING), 8, '3'), '-4') WHEN 2 THEN 'x12' WHEN 3 THEN NULL ELSE CAST(p_partkey * 40009 AS STRING) END"


@register("v2_cpv", f"WITH x AS (SELECT p_partkey, {_CPV} AS cpv FROM part), n AS (SELECT *, regexp_replace(regexp_extract(regexp_replace(cpv, '\\.0$', ''), '^([0-9]+)(-.*)?$', 1), '^0+([0-9])', '\\1') AS d FROM x) SELECT p_partkey, coalesce(length(d) BETWEEN 1 AND 8, false) AS valid, coalesce(CASE WHEN length(d) > 0 THEN substr(CASE WHEN length(d) < 8 THEN lpad(d, 8, '0') ELSE d END, 1, 2) ELSE regexp_extract(cpv, '^([0-9][0-9])', 1) END, '') AS division FROM n")
def v2(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CPV).alias("cpv"))
    return rows.select("p_partkey", identifiers.valid_cpv(F.col("cpv")).alias("valid"), identifiers.cpv_division(F.col("cpv")).alias("division"))


_NAMES = "concat(CASE c_custkey % 4 WHEN 0 THEN 'Construcciones Peña' WHEN 1 THEN 'Obras y Vías (Grupo) ' WHEN 2 THEN 'GRUPO SANITAS' ELSE 'Édison, Cía.' END, ' ', c_name, CASE c_custkey % 9 WHEN 0 THEN ', S.L.U.' WHEN 1 THEN ' S. A.' WHEN 2 THEN ' Sociedad Anonima Sociedad Unipersonal' WHEN 3 THEN ' S L' WHEN 4 THEN ' (UTE) SA SME' WHEN 5 THEN ' S.Coop' WHEN 6 THEN '; SRL' ELSE '' END)"


def _company_sql(x: str) -> str:
    x = f"translate(trim(upper({x})), '{text.ACCENTED}', '{text.PLAIN}')"
    x = f"regexp_replace({x}, '\\s*\\([^)]*\\)', '', 'g')"
    for form in fixed.DOTTED_FORMS:
        x = "regexp_replace(" + x + ", '\\b" + "\\s*\\.\\s*".join(form) + f"\\s*\\.?\\b', '{form}', 'g')"
    for form in fixed.SPACED_FORMS:
        x = "regexp_replace(" + x + ", '\\b" + "\\s+".join(form) + f"\\b', '{form}', 'g')"
    for form in fixed.FINAL_FORMS:
        x = "regexp_replace(" + x + ", '\\b" + "\\s+".join(form) + f"$', '{form}', 'g')"
    x = f"trim(regexp_replace(regexp_replace({x}, '[,.\\-]', ' ', 'g'), '\\s+', ' ', 'g'))"
    return f"trim(regexp_replace(regexp_replace({x}, '(\\s+({'|'.join(fixed.LEGAL_FORMS)}))+$', ''), '[.,;]+$', ''))"


def _buyer_sql(x: str) -> str:
    return f"""trim(regexp_replace(regexp_replace(translate(trim(upper({x})), 'ÁÉÍÓÚÑÜÇ', 'AEIOUNUC'), '[.,;:\\-/\\\\()\\[\\]"''`]', ' ', 'g'), '\\s+', ' ', 'g'))"""


@register("n1_company_key", f"SELECT c_custkey, {_company_sql(_NAMES)} AS company, {_buyer_sql(_NAMES)} AS buyer FROM customer")
def n1(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_NAMES).alias("name"))
    return rows.select("c_custkey", text.company_key(F.col("name")).alias("company"), text.buyer_key(F.col("name")).alias("buyer"))


@register("n3_company_key_anywhere", "SELECT c_custkey, trim(regexp_replace(" + "".join("replace(" for _ in fixed.QUALITY_FORMS) + f"trim(upper({_NAMES}))" + "".join(f", '{f}', '')" for f in fixed.QUALITY_FORMS) + ", '\\s+', ' ', 'g')) AS company FROM customer")
def n3(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.company_key_anywhere(F.expr(_NAMES)).alias("company"))


@register("c1_without_tags", "SELECT page_id, md5(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS text_md5 FROM pages")
def c1(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.without_tags(F.col("html")).cast("binary")).alias("text_md5"))


_AMOUNTS = "CASE p_partkey % 5 WHEN 0 THEN concat('1.', lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'), ',5 €') WHEN 1 THEN concat(CAST(p_partkey AS STRING), ',25') WHEN 2 THEN concat(CAST(p_partkey AS STRING), '.75') WHEN 3 THEN '' ELSE CAST(p_partkey AS STRING) END"


@register("m2_mixed_numbers", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 1000 + p_partkey % 1000 + 0.5e0 WHEN 1 THEN p_partkey + 0.25e0 WHEN 2 THEN p_partkey + 0.75e0 WHEN 3 THEN NULL ELSE CAST(p_partkey AS DOUBLE) END AS mixed, CASE p_partkey % 5 WHEN 0 THEN 1000 + p_partkey % 1000 + 0.5e0 WHEN 1 THEN p_partkey + 0.25e0 WHEN 2 THEN p_partkey * 100 + 75.0e0 WHEN 3 THEN NULL ELSE CAST(p_partkey AS DOUBLE) END AS spanish FROM part")
def m2(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_AMOUNTS).alias("x"))
    return rows.select("p_partkey", values.mixed_number(F.col("x")).alias("mixed"), values.spanish_number(F.col("x")).alias("spanish"))


@register("t1_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders")
def t1(spark, sf_dir):
    d = F.col("o_orderdate")
    written = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "d/M/yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'+01:00'")).when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "dd-MM-yyyy")).otherwise("sin fecha")
    return table(spark, sf_dir, "orders").select("o_orderkey", values.timestamp(written).cast("date").cast("string").alias("day"))


def _threshold_sql() -> str:
    def column(at: int) -> str:
        return "CASE " + " ".join(f"WHEN ano BETWEEN {r[0]} AND {r[1]} THEN {r[at]}" for r in fixed.THRESHOLDS) + f" ELSE {fixed.THRESHOLDS[-1][at]} END"

    return f"CAST(CASE WHEN tipo_contrato = 'Privado' THEN NULL WHEN tipo_contrato = 'Obras' THEN {column(2)} WHEN utility THEN {column(5)} WHEN state THEN {column(3)} ELSE {column(4)} END AS DOUBLE)"


def _any_sql(parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains(upper(dependencia), '{p.upper()}')" for p in parts) + ")"


SARA_SQL = f"""WITH c AS (SELECT *, {_any_sql(fixed.UTILITIES)} AS utility, {_any_sql(fixed.STATE)} AS state FROM ({CONTRACTS_SQL}) x WHERE tipo_registro = 'LICITACION' AND estado IN ('Resuelta', 'Adjudicada') AND (importe_adjudicacion IS NOT NULL OR importe_sin_iva IS NOT NULL) AND conjunto NOT IN ('menores', 'encargos', 'consultas') AND tipo_contrato NOT IN ('Privado', 'Patrimonial', 'Administrativo Especial', '22', '999', '32') AND ano BETWEEN 2010 AND 2027),
t AS (SELECT *, coalesce(importe_sin_iva, importe_adjudicacion) AS amount, {_threshold_sql()} AS threshold FROM c),
lots AS (SELECT expediente, sum(amount) AS lots_sum, count(amount) AS n_lots FROM t WHERE threshold IS NOT NULL GROUP BY 1 HAVING count(amount) >= 2 AND sum(amount) >= min(threshold)),
r AS (SELECT t.*, coalesce(amount >= threshold, false) AS is_individual, n_lots FROM t LEFT JOIN lots USING (expediente)),
s AS (SELECT *, n_lots IS NOT NULL AND NOT is_individual AND threshold IS NOT NULL AS sara_by_lots FROM r) """


def sara(spark, sf_dir) -> DataFrame:
    return coverage.classified(coverage.awarded(contracts(spark, sf_dir)))


@register("q4_sara", SARA_SQL + "SELECT id, threshold, is_individual, sara_by_lots, is_individual OR sara_by_lots AS is_sara FROM s")
def q4(spark, sf_dir):
    return sara(spark, sf_dir).select("id", "threshold", "is_individual", "sara_by_lots", "is_sara")


@register("g14_bands", SARA_SQL + "SELECT CAST(CASE WHEN amount < 100000 THEN 0 WHEN amount < 200000 THEN 100000 WHEN amount < 300000 THEN 200000 ELSE 300000 END AS DOUBLE) AS band, count(*) AS n, round(sum(amount), 2) AS total FROM s WHERE amount >= 0 GROUP BY 1")
def g14(spark, sf_dir):
    return coverage.bands(sara(spark, sf_dir), "amount", [0.0, 1e5, 2e5, 3e5]).withColumn("total", F.round("total", 2))


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as contracts; those of other priorities, repriced, as notices."""
    c = contracts(spark, sf_dir).where("row_ord % 2 = 0")
    left = c.select(F.col("row_ord").alias("left_ord"), F.col("nif_adjudicatario").alias("nif"), F.format_string("A%08d", F.col("buyer") % 50).alias("nif_organo"), F.concat_ws(" ", F.col("dependencia"), F.col("buyer") % 10).alias("organo"), "expediente", F.col("ano").alias("year"), F.col("importe_sin_iva").alias("amount"), F.lit(True).alias("is_sara"), (F.col("row_ord") % 14 == 0).alias("sara_by_lots"), (F.col("row_ord") % 22 == 0).alias("neg_sin_pub"))
    n = contracts(spark, sf_dir).where("row_ord % 2 = 1")
    amount = F.col("importe_sin_iva")
    right = n.select(F.col("row_ord").alias("right_ord"), (F.col("row_ord") / 6).cast("long").alias("notice_id"), F.col("nif_adjudicatario").alias("win_nif"), F.format_string("ES-A%08d", F.col("buyer") % 50).alias("cae_nif"), F.concat_ws(" ", F.col("dependencia"), F.col("buyer") % 10).alias("cae_name"), F.col("expediente").alias("internal_id"), F.col("ano").alias("year"), amount.alias("amount"), (amount * 2).alias("total_value"), (amount * 3).alias("estimated_value"))
    return left, right


@register("j9_candidates", f"""WITH c AS ({CONTRACTS_SQL}), l AS (SELECT * FROM c WHERE row_ord % 2 = 0 AND importe_sin_iva > 0), r AS (SELECT * FROM c WHERE row_ord % 2 = 1 AND importe_sin_iva > 0),
p AS (SELECT l.row_ord AS left_ord, r.row_ord AS right_ord, abs(l.importe_sin_iva - r.importe_sin_iva) AS diff FROM l JOIN r ON l.nif_adjudicatario = r.nif_adjudicatario AND r.ano BETWEEN l.ano - 1 AND l.ano + 1 WHERE abs(l.importe_sin_iva - r.importe_sin_iva) <= greatest(l.importe_sin_iva * 0.1e0, 5000))
SELECT left_ord, count(*) AS n, round(min(diff), 4) AS least_diff FROM p GROUP BY 1""")
def j9_candidates(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    pairs = matching.near_amounts(left, right.withColumn("nif", F.col("win_nif")), "nif", [0, 1, -1])
    return pairs.groupBy("left_ord").agg(F.count("*").alias("n"), F.round(F.min("diff"), 4).alias("least_diff"))


@register("q5_matching")
def q5(spark, sf_dir):
    """The nine strategies; their order makes it no SQL query, so tests hold it against the serial loop."""
    left, right = _sides(spark, sf_dir)
    names = [(name, alias) for name, known in fixed.ALIASES.items() for alias in known if len(alias) > 5]
    # some buyers have a name in contracts and an alias of it in notices
    known = F.create_map(*[F.lit(x) for i, pair in enumerate(names) for x in (i, F.array(*map(F.lit, pair)))])
    renamed = lambda side, column, buyer, at: side.withColumn(column, F.coalesce(F.get(F.try_element_at(known, buyer), F.lit(at)), F.col(column)))
    number = lambda c: F.regexp_extract(c, "([0-9]{8})$", 1).cast("int")
    left, right = renamed(left, "organo", number("nif_organo"), 0), renamed(right, "cae_name", number("cae_nif"), 1)
    return coverage.matched(left, right, spark.createDataFrame(names, "organo string, alias string"))


_WORDS = "list_distinct(list_filter(string_split(upper(p_name || ' ' || p_type || ' ' || p_brand), ' '), lambda x: length(x) > 2))"


@register("j10_shared_tokens", f"""WITH t AS (SELECT p_partkey, {_WORDS} AS w FROM part), e AS (SELECT p_partkey, len(w) AS n, unnest(w) AS t FROM t)
SELECT l.p_partkey AS left_ord, r.p_partkey AS right_ord, count(*) AS shared FROM e l JOIN e r ON l.t = r.t AND l.p_partkey < r.p_partkey GROUP BY l.p_partkey, r.p_partkey, l.n, r.n HAVING count(*) >= 2 AND count(*) >= 0.6 * least(l.n, r.n)""")
def j10(spark, sf_dir):
    """J10 over every pair of parts."""
    words = text.tokens(F.upper(F.concat_ws(" ", "p_name", "p_type", "p_brand")))
    parts = table(spark, sf_dir, "part").withColumn("tokens", words)
    return matching.shared_tokens(parts.withColumnRenamed("p_partkey", "left_ord"), parts.withColumnRenamed("p_partkey", "right_ord"), 0.6, 2).where("left_ord < right_ord")


@register("j12_spread", "WITH f AS (SELECT l_orderkey, min(l_linenumber) AS first FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT l.l_orderkey, l.l_linenumber, l_returnflag <> 'R' AND first IS NOT NULL AS spread, CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE first END AS found FROM lineitem l LEFT JOIN f USING (l_orderkey)")
def j12(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("file"), F.col("l_orderkey").cast("string")).alias("file"), (F.col("l_returnflag") == "R").alias("hit"))
    return matching.spread(rows.withColumn("found", F.when(F.col("hit"), F.col("l_linenumber"))), "file", "hit", "found", "l_linenumber").select("l_orderkey", "l_linenumber", "spread", "found")


_MONTHLY = "SELECT DISTINCT o_custkey AS company, l_suppkey * 100000 + year(l_shipdate) * 12 + month(l_shipdate) AS person FROM orders JOIN lineitem ON l_orderkey = o_orderkey"


@register("j14_shared_officers", f"WITH m AS ({_MONTHLY}), d AS (SELECT person FROM m GROUP BY 1 HAVING count(*) BETWEEN 2 AND 20), k AS (SELECT m.* FROM m SEMI JOIN d USING (person)) SELECT a.company AS company_a, b.company AS company_b, count(*) AS n_shared, string_agg(CAST(a.person AS VARCHAR), ',' ORDER BY a.person) AS shared FROM k a JOIN k b ON a.person = b.person AND a.company < b.company GROUP BY 1, 2")
def j14(spark, sf_dir):
    """J14 over every order and line: a person is a supplier in a month of shipping, who has few companies at any size of the tables."""
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") * 100000 + month).alias("person"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("company"))
    return graph.co_membership(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "person", "company")


@register("j5_lookup_last", "WITH x AS (SELECT o_custkey, o_orderstatus, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY 1, 2) SELECT c_custkey, priority FROM customer LEFT JOIN x ON o_custkey = c_custkey AND o_orderstatus = 'F'")
def j5(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus"))
    right = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("priority"), "o_orderkey")
    return graph.lookup_last(left, right, ["o_custkey", "o_orderstatus"], "priority", "o_orderkey").select(F.col("o_custkey").alias("c_custkey"), "priority")


@register("j6_exists", "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') END AS urgent FROM customer")
def j6(spark, sf_dir):
    right = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return graph.exists_in(table(spark, sf_dir, "customer"), right, F.col("c_custkey"), "o_custkey", F.col("c_custkey") % 3 > 0, "urgent").select("c_custkey", "urgent")


_REGISTER = "SELECT c_name, o_orderdate, c_acctbal, CASE o_orderkey % 5 WHEN 0 THEN 'Constitución' WHEN 1 THEN 'Disolución' WHEN 2 THEN 'Situación CONCURSAL' ELSE 'Otros' END AS actos FROM orders JOIN customer ON c_custkey = o_custkey"


@register("q11_anomalies", f"""WITH c AS ({CONTRACTS_SQL}), g AS ({_REGISTER}), e AS (SELECT {_company_sql("c_name")} AS k, min(o_orderdate) FILTER (actos = 'Constitución') AS inc, max(c_acctbal * 10) AS cap, min(o_orderdate) FILTER (actos = 'Disolución') AS dis, min(o_orderdate) FILTER (actos = 'Situación CONCURSAL') AS ins FROM g GROUP BY 1),
j AS (SELECT * FROM c LEFT JOIN e ON e.k = {_company_sql("adjudicatario")})
SELECT id, coalesce(floor((epoch_us(fecha_adjudicacion) - epoch_us(inc)) / 86400000000.0) BETWEEN 0 AND 180, false) AS new_company, coalesce(cap < 10000 AND importe_adjudicacion > 100000, false) AS low_capital, coalesce(floor((epoch_us(dis) - epoch_us(fecha_adjudicacion)) / 86400000000.0) BETWEEN 0 AND 365, false) AS soon_dissolved, coalesce(CAST(fecha_adjudicacion AS DATE) >= CAST(ins AS DATE), false) AS insolvent_before FROM j""")
def q11(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    kind = F.element_at(F.array(*map(F.lit, ["Constitución", "Disolución", "Situación CONCURSAL", "Otros", "Otros"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    register_ = joined.select(text.company_key(F.col("c_name")).alias("empresa_norm"), F.col("o_orderdate").alias("fecha_borme"), (F.col("c_acctbal") * 10).alias("capital_euros"), kind.alias("actos"))
    return companies.anomalies(contracts(spark, sf_dir), register_).select("id", "new_company", "low_capital", "soon_dissolved", "insolvent_before")


@register("q13_anonymised", "SELECT c_custkey, substr(sha256('salt:' || upper(trim(c_name))), 1, 16) AS persona_hash FROM customer")
def q13(spark, sf_dir):
    return companies.anonymised(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("persona")), "salt")


@register("d3_keep_last", "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def d3(spark, sf_dir):
    return dedupe.keep_last(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey")


@register("d4_keep_first", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def d4(spark, sf_dir):
    return dedupe.keep_first(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@register("d2_by_content", "SELECT lang, count(*) AS n FROM (SELECT DISTINCT text, lang FROM documents) GROUP BY 1")
def d2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", F.col("source").alias("_source"))
    return dedupe.by_content(docs).groupBy("lang").agg(F.count("*").alias("n"))


@register("g10_duplicate_report", "WITH g AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS a, count(DISTINCT o_orderpriority) AS b FROM orders GROUP BY 1 HAVING count(*) > 1), t AS (SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (a > 1) AS a, count(*) FILTER (b > 1) AS b FROM g) SELECT groups, rows, 'o_orderstatus' AS \"column\", a AS differing FROM t UNION ALL SELECT groups, rows, 'o_orderpriority', b FROM t")
def g10(spark, sf_dir):
    return dedupe.duplicate_report(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"), ["o_custkey"])


@register("w1_percentiles", "SELECT l_orderkey, l_linenumber, coalesce(l_extendedprice BETWEEN lo AND hi, false) AS inside FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, quantile_cont(l_extendedprice, 0.01) OVER w AS lo, quantile_cont(l_extendedprice, 0.99) OVER w AS hi FROM lineitem JOIN part ON p_partkey = l_partkey WINDOW w AS (PARTITION BY p_brand))")
def w1(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    out = windows.with_percentiles(lines, ["p_brand"], "l_extendedprice", lo=0.01, hi=0.99)
    return out.select("l_orderkey", "l_linenumber", F.coalesce(F.col("l_extendedprice").between(F.col("lo"), F.col("hi")), F.lit(False)).alias("inside"))


@register("w2_sessions", "WITH e AS (SELECT event_id, user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= 3600000000 THEN 0 ELSE 1 END AS new FROM events), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM e) SELECT event_id, CAST(CASE WHEN count(*) OVER (PARTITION BY user_id, run) >= 2 THEN run ELSE -1 END AS BIGINT) AS session FROM r")
def w2(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    return windows.sessions(events, "user_id", "at", 3_600_000_000).select("event_id", "session")


@register("w3_concentration", "WITH s AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders GROUP BY 1), r AS (SELECT *, sum(total) OVER (ORDER BY total DESC, o_custkey ROWS UNBOUNDED PRECEDING) / sum(total) OVER () AS share FROM s) SELECT o_custkey, CAST(total AS DOUBLE) AS total FROM r WHERE share <= 0.5")
def w3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("paid", F.col("o_totalprice").cast("decimal(18,2)"))
    return windows.concentration(orders, "o_custkey", "paid").select("o_custkey", F.col("total").cast("double").alias("total"))


@register("x1_pivot", "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS F, CAST(nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS BIGINT) AS O, CAST(nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS BIGINT) AS P FROM orders GROUP BY 1")
def x1(spark, sf_dir):
    return reshape.pivot_counts(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), "year", "o_orderstatus", ["F", "O", "P"])


@register("u1_union", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier")
def u1(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))
    return reshape.union_all([a, b])


@register("o1_top_awardees", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 15")
def o1(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")).orderBy(F.desc("total"), "o_custkey").limit(15).withColumn("total", F.round("total", 2))


@register("g13_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 8) AS correlation, round(avg(abs(l_quantity - l_linenumber)), 8) AS mean_difference, count(*) AS n FROM lineitem")
def g13(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("correlation"), F.round(F.avg(F.abs(F.col("l_quantity") - F.col("l_linenumber"))), 8).alias("mean_difference"), F.count("*").alias("n"))


@register("f10_first_class", "SELECT c_custkey, CASE WHEN contains(upper(c_mktsegment), 'AUTO') THEN 'vehicles' WHEN contains(upper(c_mktsegment), 'BUILD') OR contains(upper(c_mktsegment), 'FURN') THEN 'works' ELSE 'other' END AS class FROM customer")
def f10(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.first_class(F.col("c_mktsegment"), {"vehicles": ["auto"], "works": ["build", "furn"]}, "other").alias("class"))


@register("p4_lots", "SELECT o_orderkey, CAST(unnest(range(greatest(o_orderkey % 4, o_orderkey % 3, 1))) AS INT) AS lot_index FROM orders")
def p4(spark, sf_dir):
    some = lambda n: F.transform(F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), 1, (F.col("o_orderkey") % n).cast("int")), lambda i: i.cast("string"))
    notices = table(spark, sf_dir, "orders").select("o_orderkey", some(4).alias("ids"), some(3).alias("tender"))
    return reshape.lots(notices, "o_orderkey", ["ids", "tender"], {"value": ["tender", "ids"]}).select("o_orderkey", "lot_index")


def _matched(spark, sf_dir) -> DataFrame:
    """Classified contracts, one in five of them with a notice and one in 22 negotiated without publicity."""
    left = sara(spark, sf_dir).select(F.col("id").alias("left_ord"), "ano", F.col("ano").alias("year"), "amount", "expediente", "is_sara", "organo_contratante", "importe_adjudicacion", "nif_adjudicatario", "cpv_principal", "tipo_contrato", "conjunto", (F.col("id") % 22 == 0).alias("neg_sin_pub"))
    found = left.where("left_ord % 5 = 0").select("left_ord", F.col("left_ord").alias("right_ord"), F.lit("E1").alias("strategy"))
    return coverage.with_matches(left, found)


MATCHED_SQL = SARA_SQL + ", q AS (SELECT id, ano, amount, expediente, organo_contratante, importe_adjudicacion, nif_adjudicatario, cpv_principal, tipo_contrato, conjunto, is_individual OR sara_by_lots AS is_sara, id % 5 = 0 AS is_matched FROM s), m AS (SELECT *, is_sara AND NOT is_matched AS missing_all, is_sara AND NOT is_matched AND id % 22 <> 0 AS missing FROM q) "


@register("q6_missing", MATCHED_SQL + "SELECT id AS left_ord, is_matched, missing_all, missing FROM m")
def q6(spark, sf_dir):
    return _matched(spark, sf_dir).select("left_ord", "is_matched", "missing_all", "missing")


@register("q7_files", MATCHED_SQL + ", f AS (SELECT expediente, bool_or(is_matched) AS hit, sum(amount) AS amount FROM m WHERE is_sara GROUP BY 1) SELECT count(*) AS files, count(*) FILTER (hit) AS matched, round(sum(amount) FILTER (hit), 1) AS matched_amount FROM f")
def q7(spark, sf_dir):
    return coverage.by_file(_matched(spark, sf_dir)).withColumn("matched_amount", F.round("matched_amount", 1))


@register("g16_by_year", MATCHED_SQL + ", o AS (SELECT ano, count(*) AS sara, count(*) FILTER (is_matched) AS matched, count(*) FILTER (missing) AS missing FROM m WHERE is_sara GROUP BY 1), n AS (SELECT ano, count(*) AS notices FROM m WHERE id % 7 = 0 GROUP BY 1) SELECT ano AS year, sara, matched, missing, round_even(100.0e0 * matched / sara, 1) AS rate, round_even(sara / CAST(notices AS DOUBLE), 2) AS ratio FROM o LEFT JOIN n USING (ano)")
def g16(spark, sf_dir):
    rows = _matched(spark, sf_dir)
    out = coverage.by_year(rows, rows.where("left_ord % 7 = 0").select("year"))
    return out.toDF("year", "sara", "matched", "missing", "rate", "ratio")


@register("q12_match_rate", f"""WITH c AS ({CONTRACTS_SQL}), k AS (SELECT DISTINCT {_company_sql("c_name")} AS k FROM customer WHERE c_custkey % 3 = 0), j AS (SELECT c.importe_adjudicacion AS amount, k.k FROM c LEFT JOIN k ON k.k = {_company_sql("adjudicatario")})
SELECT count(*) AS rows, count(k) AS matched, round_even(100.0e0 * count(k) / count(*), 1) AS rate, round_even(100.0e0 * sum(amount) FILTER (k IS NOT NULL) / sum(amount), 1) AS amount_rate FROM j""")
def q12(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(text.company_key(F.col("c_name")).alias("empresa_norm"))
    return companies.match_rate(contracts(spark, sf_dir), known)


@register("g9_several_companies", "SELECT CAST(l_suppkey AS VARCHAR) AS persona_hash, count(DISTINCT l_partkey) AS n_companies FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1")
def g9(spark, sf_dir):
    return companies.several_companies(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("persona_hash"), F.col("l_partkey").alias("empresa_norm")))


@register("w4_carried", "SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS kind FROM events")
def w4(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("kind"))
    return windows.carried(events, "user_id", "event_id", "kind").select("event_id", "kind")


@register("d5_most_complete", "WITH x AS (SELECT o_custkey, o_orderkey, o_orderdate, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS o_orderpriority FROM orders) SELECT o_custkey, o_orderkey FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus IS NOT NULL)::INT + (o_orderpriority IS NOT NULL)::INT DESC, o_orderdate DESC, o_orderkey DESC) = 1")
def d5(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.when(key % 3 > 0, F.col("o_orderstatus")).alias("o_orderstatus"), F.when(key % 4 > 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return dedupe.most_complete(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@register("c7_unique_join", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def c7(spark, sf_dir):
    of = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("p"))
    return of.select("o_custkey", text.unique_join(F.col("p")).alias("priorities"))


@register("c2_known_or_null", "SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN p_name END AS name FROM part")
def c2(spark, sf_dir):
    written = F.when(F.col("p_partkey") % 4 == 0, "nan").when(F.col("p_partkey") % 4 == 1, "None").when(F.col("p_partkey") % 4 == 2, "").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.known_or_null(written).alias("name"))


@register("g12_scalars", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS buyers, count(CASE WHEN o_orderkey % 19 > 0 THEN 1 END) AS with_amount, round(sum(o_totalprice), 1) AS total, round(quantile_cont(o_totalprice, 0.5), 3) AS median, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders")
def g12(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("buyers"), F.count_if(F.col("o_orderkey") % 19 > 0).alias("with_amount"), F.round(F.sum(price), 1).alias("total"), F.round(F.percentile(price, 0.5), 3).alias("median"), F.min(price).alias("least"), F.max(price).alias("most"))
