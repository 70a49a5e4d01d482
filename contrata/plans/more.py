"""More queries over the driver's tables: studies of missing contracts, single functions, sources and sinks over files that the query itself writes.

Oracles are written from the rules, not from this library's expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.functions import fixed, identifiers, text, values
from contrata.operators import dedupe, graph, matching, reshape
from contrata.operators.cut import cut, shared_folder
from contrata.plans import companies, coverage, health, quality
from contrata.plans.driver import CONTRACTS_SQL, MATCHED_SQL, _matched, contracts, table
from contrata.plans.registry import register
from contrata.sources import feeds, gazette, readers, sinks
from contrata.streaming import incremental


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


# F1-F3

_REPORT = [("awards", "tipo_registro = 'LICITACION' AND estado IN ('Resuelta', 'Adjudicada') AND nif_adjudicatario IS NOT NULL AND (importe_adjudicacion IS NOT NULL OR importe_sin_iva IS NOT NULL)"), ("menores", "conjunto <> 'menores'"), ("encargos", "conjunto <> 'encargos'"), ("consultas", "conjunto <> 'consultas'"), ("types", "tipo_contrato NOT IN ('Privado', 'Patrimonial', 'Administrativo Especial', '22', '999', '32')"), ("years", "ano BETWEEN 2010 AND 2027")]


def _report_sql() -> str:
    before, out = "true", []
    for name, condition in _REPORT:
        out.append(f"count(*) FILTER ({before} AND NOT ({condition})) AS {name}")
        before = f"{before} AND ({condition})"
    return f"SELECT count(*) AS rows, {', '.join(out)}, count(*) FILTER ({before}) AS kept FROM ({CONTRACTS_SQL}) c"


@register("f2_award_report", _report_sql())
def f2(spark, sf_dir):
    return coverage.award_report(contracts(spark, sf_dir))


# The health sector

_HEALTH_SQL = "regexp_matches(upper(organo_contratante), '" + "|".join(fixed.HEALTH) + "')"
_REGION_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(upper(organo_contratante), '{p}')" for p in parts) + f" THEN '{name}'" for name, parts in fixed.REGIONS.items()) + " ELSE 'Otros' END"
HEALTH_SQL = MATCHED_SQL + f", h AS (SELECT *, {_REGION_SQL} AS region FROM m WHERE is_sara AND {_HEALTH_SQL}) "
PATTERNS_SQL = (
    HEALTH_SQL
    + """, g AS (SELECT organo_contratante, ano, count(importe_adjudicacion) AS n, count(DISTINCT nif_adjudicatario) AS n_winners, sum(importe_adjudicacion) AS total, avg(importe_adjudicacion) AS mean, stddev_samp(importe_adjudicacion) AS std, count(DISTINCT expediente) AS n_files FROM h WHERE missing GROUP BY 1, 2),
lr AS (SELECT *, n_files / greatest(n, 1) AS files_share, std / greatest(mean, 1) AS variation FROM g),
p AS (SELECT *, CASE WHEN n >= 5 AND files_share < 0.3 THEN 'lotes_mismo_expediente' WHEN n >= 5 AND files_share >= 0.3 AND variation < 0.5 THEN 'acuerdo_marco_homogeneo' WHEN n >= 5 AND files_share >= 0.3 AND variation >= 0.5 THEN 'contratos_recurrentes' WHEN n >= 2 AND n < 5 THEN 'grupo_pequeno' ELSE 'individual' END AS pattern FROM lr) """
)


def _health(spark, sf_dir) -> DataFrame:
    rows = _matched(spark, sf_dir).where("is_sara")
    return rows.where(health.is_health(F.col("organo_contratante"))).withColumn("region", health.region(F.col("organo_contratante")))


def _patterns(spark, sf_dir) -> DataFrame:
    return health.lot_patterns(_health(spark, sf_dir).where("missing"))


@register("q10_lot_patterns", PATTERNS_SQL + "SELECT organo_contratante, ano, n, n_winners, n_files, round(total, 1) AS total, round(files_share, 6) AS files_share, round(variation, 6) AS variation, pattern FROM p")
def q10(spark, sf_dir):
    return _patterns(spark, sf_dir).select("organo_contratante", "ano", "n", "n_winners", "n_files", F.round("total", 1).alias("total"), F.round("files_share", 6).alias("files_share"), F.round("variation", 6).alias("variation"), "pattern")


@register("g6_pattern_totals", PATTERNS_SQL + "SELECT pattern, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_contracts, round(sum(total), 1) AS total FROM p GROUP BY 1")
def g6(spark, sf_dir):
    return health.pattern_totals(_patterns(spark, sf_dir)).withColumn("total", F.round("total", 1))


_COUNTS_SQL = "count(*) AS n, count(*) FILTER (is_matched) AS n_matched, count(*) FILTER (missing) AS n_missing, round(sum(importe_adjudicacion), 1) AS total, round_even(100.0e0 * count(*) FILTER (is_matched) / greatest(count(*), 1), 1) AS rate"


@register("q10_regions", HEALTH_SQL + f"SELECT region, {_COUNTS_SQL} FROM h GROUP BY 1")
def q10_regions(spark, sf_dir):
    return health.profile(_health(spark, sf_dir), ["region"]).withColumn("total", F.round("total", 1))


@register("q10_buyers", HEALTH_SQL + f"SELECT organo_contratante, tipo_contrato, {_COUNTS_SQL} FROM h GROUP BY 1, 2")
def q10_buyers(spark, sf_dir):
    return health.profile(_health(spark, sf_dir), ["organo_contratante", "tipo_contrato"]).withColumn("total", F.round("total", 1))


@register("q10_goods", HEALTH_SQL + f"SELECT substr(cpv_principal, 1, 4) AS goods, {_COUNTS_SQL} FROM h WHERE substr(cpv_principal, 1, 2) = '33' GROUP BY 1")
def q10_goods(spark, sf_dir):
    return health.by_goods(_health(spark, sf_dir), 4, "33").withColumn("total", F.round("total", 1))


def _sides_sql() -> str:
    def side(name: str) -> str:
        share = lambda condition: f"round_even(100.0e0 * count(*) FILTER ({condition}) / greatest(count(*), 1), 1)"
        types = ", ".join(f"{share(f'tipo_contrato = {chr(39)}{t}{chr(39)}')} AS share_{t.lower()}" for t in ("Servicios", "Suministros", "Obras"))
        edges = [0, 221000, 500000, 1000000, 5000000, 1e300]
        bands = ", ".join(f"{share(f'importe_adjudicacion >= {lo} AND importe_adjudicacion < {hi}')} AS share_{i}" for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)))
        return f"SELECT '{name}' AS side, count(*) AS n, round(avg(importe_adjudicacion), 3) AS mean, round(quantile_cont(importe_adjudicacion, 0.5), 3) AS median, {types}, {bands} FROM h WHERE {'is_matched' if name == 'matched' else name}"

    return f"{HEALTH_SQL} {side('matched')} UNION ALL {side('missing')}"


@register("q10_sides", _sides_sql())
def q10_sides(spark, sf_dir):
    return health.matched_against_missing(_health(spark, sf_dir)).withColumns({"mean": F.round("mean", 3), "median": F.round("median", 3)})


@register("g18_adjusted_coverage", PATTERNS_SQL + ", hc AS (SELECT count(*) FILTER (is_matched) AS matched, count(*) FILTER (missing) AS missing FROM h), hl AS (SELECT count(*) AS n_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS in_groups FROM p WHERE pattern IN ('lotes_mismo_expediente', 'acuerdo_marco_homogeneo')) SELECT matched, missing, n_groups, in_groups, matched + missing - in_groups + n_groups AS adjusted_total, round_even(100.0e0 * matched / greatest(matched + missing - in_groups + n_groups, 1), 1) AS coverage FROM hc, hl")
def g18(spark, sf_dir):
    return health.adjusted_coverage(_health(spark, sf_dir), _patterns(spark, sf_dir))


# Q9: reasons to doubt

DIAGNOSED_SQL = (
    MATCHED_SQL
    + """, b AS (SELECT DISTINCT organo_contratante AS o FROM m WHERE is_matched), k AS (SELECT organo_contratante AS o, ano AS y, count(expediente) AS n FROM m WHERE missing GROUP BY 1, 2),
d AS (SELECT m.id, m.organo_contratante IN (SELECT o FROM b) AS buyer_seen, m.ano BETWEEN 2010 AND 2015 AS early, coalesce(m.importe_adjudicacion >= 139000 AND m.importe_adjudicacion < 221000, false) AS grey, k.n >= 5 AS many, m.organo_contratante IN (SELECT o FROM b) AND coalesce(m.ano >= 2016 AND m.importe_adjudicacion >= 221000, false) AS sure FROM m JOIN k ON k.o = m.organo_contratante AND k.y = m.ano WHERE missing) """
)


@register("q9_diagnosis", DIAGNOSED_SQL + "SELECT id AS left_ord, buyer_seen, early, grey, many, sure FROM d")
def q9(spark, sf_dir):
    return coverage.diagnosis(_matched(spark, sf_dir)).select("left_ord", "buyer_seen", "early", "grey", "many", "sure")


@register("q9_report", DIAGNOSED_SQL + " UNION ALL ".join(f"SELECT count(*) AS missing, '{name}' AS class, count(*) FILTER ({condition}) AS n, round_even(100.0e0 * count(*) FILTER ({condition}) / greatest(count(*), 1), 1) AS share FROM d" for name, condition in (("buyer_unseen", "NOT buyer_seen"), ("early", "early"), ("grey", "grey"), ("many", "many"), ("sure", "sure"))))
def q9_report(spark, sf_dir):
    return coverage.diagnosis_report(coverage.diagnosis(_matched(spark, sf_dir)))


@register("q9_years", MATCHED_SQL + ", o AS (SELECT ano AS year, count(*) AS sara, count(*) FILTER (is_matched) AS matched, count(*) FILTER (missing) AS missing FROM m WHERE is_sara GROUP BY 1), n AS (SELECT ano AS year, count(*) AS notices FROM m WHERE id % 7 = 0 GROUP BY 1) SELECT year, sara, matched, missing, coalesce(notices, 0) AS notices, round_even(100.0e0 * missing / sara, 1) AS share_missing, round_even(coalesce(notices, 0) / CAST(sara AS DOUBLE), 2) AS ratio FROM o LEFT JOIN n USING (year) WHERE year BETWEEN 2010 AND 2026")
def q9_years(spark, sf_dir):
    rows = _matched(spark, sf_dir)
    return coverage.coverage_by_year(rows, rows.where("left_ord % 7 = 0").select("year"))


def _notices(c: DataFrame) -> DataFrame:
    """Every contract once more, as a notice a little dearer."""
    return c.select(F.col("row_ord").alias("right_ord"), F.col("nif_adjudicatario").alias("win_nif"), F.col("expediente").alias("internal_id"), F.col("organo_contratante").alias("name"), F.col("ano").alias("year"), (F.col("importe_sin_iva") * 1.04).alias("amount"))


@register("q9_recoverable")
def q9_recoverable(spark, sf_dir):
    """Its first-fit order makes it no SQL query; tests hold it against the loop."""
    rows = _matched(spark, sf_dir).where("missing").select("left_ord", F.col("organo_contratante").alias("name"), "year", "amount")
    return coverage.recoverable(rows, _notices(contracts(spark, sf_dir)), "name")


@register("q6_high_confidence", MATCHED_SQL + "SELECT id AS left_ord, amount FROM m WHERE missing AND ano >= 2016 AND amount >= 221000 AND nif_adjudicatario IN (SELECT nif_adjudicatario FROM m WHERE id % 3 = 0)")
def q6_high(spark, sf_dir):
    rows = _matched(spark, sf_dir).withColumn("nif_organo", F.col("nif_adjudicatario"))
    return coverage.high_confidence(rows, rows.where("left_ord % 3 = 0").select("nif_organo")).select("left_ord", "amount")


# Q8: the simple validation

def _simple(spark, sf_dir) -> DataFrame:
    # both sides are made of contracts, which are joined once
    every = cut(contracts(spark, sf_dir).select("row_ord", "nif_adjudicatario", "expediente", "ano", "importe_sin_iva", "importe_adjudicacion", "conjunto", "organo_contratante", "tipo_registro", "estado"))
    c = every.where("tipo_registro = 'LICITACION' and estado in ('Resuelta', 'Adjudicada') and importe_adjudicacion is not null")
    rows = c.select(F.col("row_ord").alias("left_ord"), F.col("nif_adjudicatario").alias("nif"), "expediente", F.col("ano").alias("year"), F.col("importe_adjudicacion").alias("amount"), (F.col("conjunto") == "menores").alias("is_minor"), "organo_contratante")
    return coverage.simple_validation(rows, _notices(every).where("right_ord % 3 > 0"))


@register("q8_validation")
def q8(spark, sf_dir):
    """Each notice is used once, in order, so it is no SQL query; tests hold it against the serial loop."""
    return _simple(spark, sf_dir).select("left_ord", "strategy", "validated", "missing", "excess")


@register("q8_limits", MATCHED_SQL + " UNION ALL ".join(f"SELECT {x}.0e0 AS least, count(*) FILTER (importe_adjudicacion >= {x}) AS n FROM m WHERE missing" for x in (140000, 215000, 500000, 1000000, 5000000)))
def q8_limits(spark, sf_dir):
    return coverage.at_least(_matched(spark, sf_dir).where("missing"), "importe_adjudicacion", [140_000, 215_000, 500_000, 1_000_000, 5_000_000])


@register("g15_notice_indicators", MATCHED_SQL + ", e AS (SELECT organo_contratante, count(*) AS n, count(*) FILTER (amount >= 140000) AS o, count(*) FILTER (missing) AS mi, count(*) FILTER (is_matched) AS v FROM m GROUP BY 1) SELECT organo_contratante, v AS n_validated, round(100.0e0 * v / n, 8) AS share_validated, CASE WHEN o >= 3 THEN o END AS n_over, CASE WHEN o >= 3 THEN mi END AS n_missing, round(CASE WHEN o >= 3 THEN 100.0e0 * mi / o END, 8) AS share_missing FROM e")
def g15(spark, sf_dir):
    of = coverage.notice_indicators(_matched(spark, sf_dir).withColumn("validated", F.col("is_matched")), "organo_contratante")
    return of.withColumns({c: F.round(c, 8) for c in ("share_validated", "share_missing")})


# Q2, Q11-Q14, J4, J7, J13

@register("q2_cross_checks", f"""WITH c AS ({CONTRACTS_SQL}), x AS (SELECT expediente, nif_adjudicatario, arg_max(row_ord % 2 = 0, row_ord) AS found FROM c WHERE row_ord % 3 = 0 GROUP BY 1, 2),
k AS (SELECT DISTINCT {"replace(" * len(fixed.QUALITY_FORMS)}trim(upper(c_name)){"".join(f", '{f}', '')" for f in fixed.QUALITY_FORMS)} AS name FROM customer WHERE c_custkey % 2 = 0),
n AS (SELECT c.*, trim(regexp_replace({"replace(" * len(fixed.QUALITY_FORMS)}trim(upper(adjudicatario)){"".join(f", '{f}', '')" for f in fixed.QUALITY_FORMS)}, '\\s+', ' ', 'g')) AS name FROM c)
SELECT n.id, x.found AS cons_20, CASE WHEN regexp_matches(upper(trim(n.nif_adjudicatario)), '^[A-HJ-NP-SUVW]') AND n.name <> '' THEN n.name IN (SELECT name FROM k) END AS cons_18 FROM n LEFT JOIN x ON x.expediente = n.expediente AND x.nif_adjudicatario = n.nif_adjudicatario""")
def q2(spark, sf_dir):
    c = contracts(spark, sf_dir)
    found = c.where("row_ord % 3 = 0").select("expediente", "nif_adjudicatario", (F.col("row_ord") % 2 == 0).alias("found"), "row_ord")
    register_ = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_name").alias("empresa"))
    return quality.with_cross_checks(c, found, register_).select("id", "cons_20", "cons_18")


@register("q14_officer_graph", "WITH m AS (SELECT DISTINCT o_custkey AS company, concat('p', CAST(l_suppkey AS VARCHAR), '-', CAST(year(l_shipdate) * 12 + month(l_shipdate) AS VARCHAR)) AS person FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'), d AS (SELECT person FROM m GROUP BY 1 HAVING count(*) BETWEEN 2 AND 20), k AS (SELECT m.* FROM m SEMI JOIN d USING (person)) SELECT a.company AS company_a, b.company AS company_b, count(*) AS n_shared, string_agg(a.person, ',' ORDER BY a.person) AS shared FROM k a JOIN k b ON a.person = b.person AND a.company < b.company GROUP BY 1, 2")
def q14(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("p"), F.col("l_suppkey").cast("string"), F.lit("-"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("string")).alias("persona_hash"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("empresa_norm"), F.when(F.col("o_orderstatus") == "F", "nombramiento").otherwise("cese").alias("tipo_acto"))
    return companies.officer_graph(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


@register("j7_details", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 = 1 THEN 'done' END, 'missing') AS detail_status, CASE WHEN c_custkey % 4 = 1 THEN c_name END AS detail FROM customer")
def j7(spark, sf_dir):
    of = table(spark, sf_dir, "customer")
    return graph.with_details(of.select("c_custkey"), of.where("c_custkey % 4 = 1").select("c_custkey", F.lit("done").alias("detail_status"), F.col("c_name").alias("detail")), ["c_custkey"])


@register("j2_rows_in_groups", "WITH g AS (SELECT o_custkey, year(o_orderdate) AS y FROM orders GROUP BY 1, 2 HAVING count(*) >= 3) SELECT count(*) AS n FROM orders JOIN g ON g.o_custkey = orders.o_custkey AND g.y = year(o_orderdate)")
def j2(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    groups = rows.groupBy("o_custkey", "y").count().where("count >= 3")
    return rows.join(groups, ["o_custkey", "y"], "left_semi").agg(F.count("*").alias("n"))


@register("j13_first_fit", "SELECT l.p_partkey AS left_ord, l.p_partkey + 1 AS right_ord FROM part l JOIN part r ON r.p_partkey = l.p_partkey + 1 WHERE l.p_partkey % 2 = 0")
def j13(spark, sf_dir):
    """Even parts may take the next odd one; every other one of them also the one after that, which the next even part may have alone."""
    of = table(spark, sf_dir, "part").select("p_partkey")
    even, odd = of.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("left_ord")), of.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("right_ord"))
    pairs = even.withColumn("right_ord", F.explode(F.when(F.col("left_ord") % 4 == 0, F.array(F.col("left_ord") + 1, F.col("left_ord") + 3)).otherwise(F.array(F.col("left_ord") + 1)))).join(odd, "right_ord", "left_semi")
    has_own = odd.select((F.col("right_ord") - 1).alias("left_ord"))
    return matching.first_fit(pairs.join(has_own, "left_ord", "left_semi")).select("left_ord", "right_ord")


# Functions

@register("n2_company_key_once", "WITH n AS (SELECT c_custkey, concat(upper(c_name), CASE c_custkey % 6 WHEN 0 THEN ' SA SME' WHEN 1 THEN ' SOCIEDAD LIMITADA' WHEN 2 THEN ', S.L.' WHEN 3 THEN ' SL;' WHEN 4 THEN ' SOCIEDAD ANONIMA SL' ELSE ' SLNE' END) AS x, upper(c_name) AS b FROM customer) SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN b WHEN 1 THEN b WHEN 2 THEN b || ', S.L' WHEN 3 THEN b || ' SL' WHEN 4 THEN b || ' SOCIEDAD ANONIMA' ELSE b END AS company FROM n")
def n2(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, [" sa sme ", " Sociedad Limitada", ", S.L.", " SL;", " Sociedad Anonima SL", " SLNE"])), (F.col("c_custkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.company_key_once(F.concat(F.col("c_name"), ends)).alias("company"))


@register("n5_key_words", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'HOSPITAL,NINO,JESUS' WHEN 1 THEN 'METRO,MADRID' ELSE 'AGUAS' END AS words FROM customer")
def n5(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ["Dirección General del Hospital Niño Jesús", "Metro de Madrid, S.A.", "Servicio Público de Aguas (S.L.)"])), (F.col("c_custkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(text.key_words(name), ",").alias("words"))


@register("n7_labels", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'n_lotes' WHEN 1 THEN 'fecha_de_difusion' ELSE 'compra_publica_estratexica' END AS label FROM customer")
def n7(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, ["Nº lotes", " Fecha de difusión: ", "Compra pública (estratéxica)"])), (F.col("c_custkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.label_key(label).alias("label"))


@register("n8_identifiers", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'A' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') WHEN 1 THEN 'B' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '' END AS nif, CASE c_custkey % 5 WHEN 0 THEN 'A' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') WHEN 1 THEN 'B' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '' END AS winner, CASE c_custkey % 2 WHEN 0 THEN 'A' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '77' END AS picked FROM customer")
def n8(spark, sf_dir):
    number = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    at = F.col("c_custkey") % 5
    written = F.when(at == 0, F.concat(F.lit("es-a"), number)).when(at == 1, F.concat(F.lit(" B"), number, F.lit(" "))).when(at == 2, "ES-").when(at == 3, "N/A").otherwise(None)
    own = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("12345"), F.concat(F.lit("A"), number), F.lit("77"))).otherwise(F.array(F.lit("12345"), F.lit("77")))
    return table(spark, sf_dir, "customer").select("c_custkey", identifiers.clean_nif(written).alias("nif"), identifiers.clean_winner_nif(written).alias("winner"), identifiers.pick_nif(own).alias("picked"))


@register("j8_labels", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Resuelta' WHEN 'O' THEN 'Publicada' ELSE o_orderstatus END AS state, CASE o_orderkey % 4 WHEN 0 THEN 'Suministros' WHEN 1 THEN 'Servicios' WHEN 2 THEN 'Obras' ELSE 'Otro Tipo' END AS type FROM orders")
def j8(spark, sf_dir):
    written = F.element_at(F.array(*map(F.lit, [" SUMINISTROS ", "contrato de servicios", "Obras públicas", "otro tipo"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", identifiers.label_of(F.col("o_orderstatus"), {"F": "Resuelta", "O": "Publicada"}).alias("state"), text.contract_type(written).alias("type"))


@register("c6_texts", "SELECT c_custkey, 'C/ MAYOR ' || CAST(c_custkey AS VARCHAR) AS address, CASE c_custkey % 3 WHEN 0 THEN 'hola' WHEN 1 THEN 'hello' ELSE 'salut' END AS said, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def c6(spark, sf_dir):
    key = F.col("c_custkey")
    languages = F.when(key % 3 == 0, F.create_map(F.lit("eng"), F.array(F.lit("hello")), F.lit("spa"), F.array(F.lit("hola")))).when(key % 3 == 1, F.create_map(F.lit("ENG"), F.array(F.lit("hello")), F.lit("fra"), F.array(F.lit("salut")))).otherwise(F.create_map(F.lit("fra"), F.array(F.lit("salut"))))
    return table(spark, sf_dir, "customer").select("c_custkey", text.address_tail(F.concat(F.lit("C/ MAYOR "), key.cast("string"), F.lit(" (MADRID)"))).alias("address"), text.preferred_language(languages).alias("said"), text.record_id(F.concat(key.cast("string"), F.lit(".0"))).alias("id"))


@register("c9_first_scalars", "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '1' WHEN 1 THEN 'x' WHEN 2 THEN 'y' WHEN 3 THEN NULL WHEN 4 THEN 'plain' ELSE '7' END AS x FROM customer")
def c9(spark, sf_dir):
    written = F.element_at(F.array(*map(F.lit, ["[1, 2]", '{"spa": [], "eng": ["x"]}', '{"a": "", "b": "y"}', "[]", "plain", "7"])), (F.col("c_custkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.first_scalar(written).alias("x"))


@register("m4_amounts", f"SELECT id, coalesce(CASE WHEN importe_adjudicacion > 200000 THEN importe_adjudicacion END, importe_sin_iva, 1.5e0) AS notice, CASE WHEN importe_adjudicacion > 0 THEN importe_adjudicacion ELSE importe_sin_iva END AS own, round(importe_adjudicacion / nullif(CASE WHEN id % 5 > 0 THEN importe_sin_iva ELSE 0 END, 0), 9) AS ratio FROM ({CONTRACTS_SQL}) c")
def m4(spark, sf_dir):
    award, budget = F.col("importe_adjudicacion"), F.col("importe_sin_iva")
    return contracts(spark, sf_dir).select("id", values.notice_amount(F.when(award > 200_000, award), budget, F.lit("1.5"), F.lit("2")).alias("notice"), values.match_amount(award, budget).alias("own"), F.round(values.ratio(award, F.when(F.col("id") % 5 > 0, budget).otherwise(0.0)), 9).alias("ratio"))


@register("t2_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00') END AS iso, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, CAST(CASE o_orderkey % 3 WHEN 2 THEN 2019 ELSE year(o_orderdate) END AS INT) AS year FROM orders")
def t2(spark, sf_dir):
    at = F.col("o_orderkey") % 3
    written = F.when(at == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(at == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    full = F.when(at < 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+0100'"))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.iso_text(written).alias("iso"), values.day_prefix(full).alias("day"), values.year_of(values.timestamp(written), name=F.concat(F.col("o_orderkey").cast("string"), F.lit("-2019"))).alias("year"))


@register("g20_category_totals", "SELECT o_orderpriority AS category, round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice WHEN o_orderpriority = '2-HIGH' THEN o_shippriority_like ELSE 1 END), 1) AS total FROM (SELECT *, CAST(o_custkey AS DOUBLE) AS o_shippriority_like FROM orders) GROUP BY 1")
def g20(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category"), "o_totalprice", F.col("o_custkey").cast("double").alias("other"), F.lit(1.0).alias("one"))
    return reshape.category_totals(rows, "category", {"1-URGENT": "o_totalprice", "2-HIGH": "other"}, "one").withColumn("total", F.round("total", 1))


@register("g11_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def g11(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_orderpriority")


@register("u3_sets", "SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')) AS both, (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS either")
def u3(spark, sf_dir):
    """U3, U4, D-1: names in both, ids in either, each once; the counts are two scalars."""
    of = lambda condition: table(spark, sf_dir, "orders").where(condition).select("o_custkey")
    both = of("o_orderstatus = 'F'").intersect(of("o_orderstatus = 'O'")).agg(F.count("*").alias("both"))
    return both.join(of("o_orderstatus = 'P'").unionByName(of("o_orderpriority = '1-URGENT'")).distinct().agg(F.count("*").alias("either")))


# Parsers

@register("p1_feed_entries", f"SELECT expediente, CASE id % 4 WHEN 0 THEN 'Obras' WHEN 1 THEN 'Servicios' WHEN 2 THEN 'Suministros' ELSE '77' END AS tipo_contrato, CASE id % 3 WHEN 0 THEN 'Adjudicada' WHEN 1 THEN 'Resuelta' ELSE 'Publicada' END AS estado, importe_sin_iva, importe_adjudicacion, nif_adjudicatario, organo_contratante, 'ESTADO > ' || dependencia AS dependencia, CASE WHEN importe_adjudicacion IS NOT NULL THEN id % 13 END AS num_ofertas, cpv_principal || ';45000000' AS cpvs, strftime(fecha_publicacion, '%Y-%m-%d') AS fecha_publicacion, url FROM ({CONTRACTS_SQL}) c")
def p1(spark, sf_dir):
    """Contracts written as feed entries, read back as records."""
    c, key = contracts(spark, sf_dir), F.col("id")
    tag = lambda name, *inside: F.concat(F.lit(f"<{name}>"), *[F.coalesce(x.cast("string"), F.lit("")) if not isinstance(x, str) else F.lit(x) for x in inside], F.lit(f"</{name.split(' ')[0]}>"))
    code = lambda n, *codes: F.element_at(F.array(*map(F.lit, codes)), (key % n + 1).cast("int"))
    amount = lambda x: F.format_string("%.17g", x)
    named = lambda x: tag("cac:PartyName", tag("cbc:Name", x))
    located = tag("cac-place-ext:LocatedContractingParty", tag("cac:Party", named(F.col("organo_contratante"))), tag("cac-place-ext:ParentLocatedParty", named(F.col("dependencia")), tag("cac-place-ext:ParentLocatedParty", named(F.lit("ESTADO")))))
    goods = F.concat(*[tag("cac:RequiredCommodityClassification", tag("cbc:ItemClassificationCode", x)) for x in (F.col("cpv_principal"), F.lit("45000000"))])
    project = tag("cac:ProcurementProject", tag("cbc:TypeCode", code(4, "3", "2", "1", "77")), tag("cac:BudgetAmount", tag('cbc:TaxExclusiveAmount currencyID="EUR"', amount(F.col("importe_sin_iva")))), goods)
    project = F.when(F.col("importe_sin_iva").isNull(), tag("cac:ProcurementProject", tag("cbc:TypeCode", code(4, "3", "2", "1", "77")), goods)).otherwise(project)
    result = tag("cac:TenderResult", tag("cbc:ReceivedTenderQuantity", key % 13), tag("cac:WinningParty", tag("cac:PartyIdentification", tag('cbc:ID schemeName="NIF"', F.col("nif_adjudicatario")))), tag("cac:AwardedTenderedProject", tag("cac:LegalMonetaryTotal", tag("cbc:TaxExclusiveAmount", amount(F.col("importe_adjudicacion"))))))
    result = F.when(F.col("importe_adjudicacion").isNull(), tag("cac:TenderResult", tag("cac:WinningParty", tag("cac:PartyIdentification", tag('cbc:ID schemeName="NIF"', F.col("nif_adjudicatario")))))).otherwise(result)
    notice = tag("cac-place-ext:ValidNoticeInfo", tag("cac-place-ext:AdditionalPublicationStatus", tag("cac-place-ext:AdditionalPublicationDocumentReference", tag("cbc:IssueDate", F.date_format("fecha_publicacion", "yyyy-MM-dd")))))
    status = tag("cac-place-ext:ContractFolderStatus", tag("cbc:ContractFolderID", F.col("expediente")), tag("cbc-place-ext:ContractFolderStatusCode", code(3, "ADJ", "RES", "PUB")), located, project, result, notice)
    link = F.when(F.col("url").isNotNull(), F.concat(F.lit('<link href="'), F.col("url"), F.lit('"/>'))).otherwise("")
    files = c.select(F.concat(F.lit("<feed>"), tag("entry", tag("id", key), link, status), F.lit("</feed>")).alias("content"))
    wanted = ["expediente", "tipo_contrato", "estado", "importe_sin_iva", "importe_adjudicacion", "nif_adjudicatario", "organo_contratante", "dependencia", "num_ofertas", "cpvs", "fecha_publicacion", "url"]
    return feeds.contract_records(feeds.entries(files)).select(*wanted)


@register("p3_flat_documents", "WITH l AS (SELECT l_orderkey, string_agg('N' || CAST(l_suppkey AS VARCHAR), ';' ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR) || ';') AS winners, first('N' || CAST(l_suppkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR) || ';') AS winner, min(l_shipdate) AS a, max(l_shipdate) AS b, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(o_orderkey AS VARCHAR) AS id_expediente, CASE WHEN o_orderkey % 2 = 0 THEN 'Servicios' ELSE 'otro' END AS tipo_contrato, CASE WHEN o_orderkey % 2 = 0 THEN 'SERV' ELSE '' END AS tipo_contrato_codigo, winner AS adjudicatario_nif, CASE WHEN n > 1 THEN winners ELSE '' END AS todos_adjudicatarios_nif, CAST(n AS INT) AS num_adjudicaciones, strftime(a, '%Y-%m-%d') AS anuncio_primera_fecha, strftime(b, '%Y-%m-%d') AS anuncio_ultima_fecha, strftime(o_orderdate, '%Y-%m-%d') AS fecha_publicacion, '33;' || o_orderstatus AS cpv, '' AS codigo_dir3, '/perfiles-licitaciones/detalle-licitacion?idExpediente=' || CAST(o_orderkey AS VARCHAR) AS url_detalle FROM orders JOIN l ON l_orderkey = o_orderkey")
def p3(spark, sf_dir):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+0100'")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("N"), F.col("l_suppkey").cast("string"), F.lit(";")).alias("nif"), stamp("l_shipdate").alias("at")))).alias("l"))
    rows = table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    shared = F.to_json(F.struct(F.col("o_orderkey").alias("idExpediente"), stamp("o_orderdate").alias("fechaPublicacion"), F.array(F.lit("33"), F.col("o_orderstatus")).alias("codigosCpv"), F.transform("l", lambda x: F.struct(x["nif"].alias("nifAdjudicatario"))).alias("adjudicaciones"), F.transform("l", lambda x: F.struct(x["at"].alias("fechaPublicacion"))).alias("anuncios")))
    kind = F.when(F.col("o_orderkey") % 2 == 0, '{"tipoContrato": {"codigo": "SERV", "descripcion": "Servicios"}, ').otherwise('{"tipoContrato": "otro", ')
    flat = feeds.flat_documents(rows.select(F.concat(kind, F.substring(shared, 2, 1 << 30)).alias("doc")), "doc")
    return flat.select("id_expediente", "tipo_contrato", "tipo_contrato_codigo", "adjudicatario_nif", "todos_adjudicatarios_nif", "num_adjudicaciones", "anuncio_primera_fecha", "anuncio_ultima_fecha", "fecha_publicacion", "cpv", "codigo_dir3", "url_detalle")


@register("p4_lot_values", "WITH l AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR), CASE WHEN l_returnflag = 'N' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE '' END) - 1 AS i, l_suppkey, l_quantity, l_returnflag FROM lineitem) SELECT l_orderkey, CAST(i AS INT) AS lot_index, CASE WHEN l_returnflag = 'N' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE 'r' || CAST(l_linenumber AS VARCHAR) END AS value, CAST(l_suppkey AS VARCHAR) AS win_nationalid, 'small' AS win_size, CASE i WHEN 0 THEN 'ES' ELSE '' END AS win_country FROM l")
def p4_values(spark, sf_dir):
    line = F.struct("l_linenumber", F.col("l_suppkey").cast("string").alias("winner"), F.when(F.col("l_returnflag") == "N", F.col("l_quantity").cast("int").cast("string")).otherwise("").alias("tender"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("l"))
    of = lambda name: F.transform("l", lambda x: x[name])
    none = F.expr("cast(array() as array<string>)")
    columns = {"winner_names": none, "winner_ids": of("winner"), "winner_countries": F.array(F.lit("ES")), "winner_sizes": F.array(F.lit("small")), "winner_dates": none, "tender_values": of("tender"), "result_values": F.transform("l", lambda x: F.concat(F.lit("r"), x["l_linenumber"].cast("string"))), "estimated_values": none, "offers": none, "lot_ids": none, "result_lot_ids": none}
    notices = rows.select("l_orderkey", F.lit("can-standard").alias("notice_type"), *[c.alias(n) for n, c in columns.items()])
    return feeds.notice_lots(notices, ["l_orderkey"]).select("l_orderkey", "lot_index", "value", "win_nationalid", "win_size", "win_country")


@register("p6_detail_pages", "SELECT c_custkey, 'REF-' || CAST(c_custkey AS VARCHAR) AS referencia, c_custkey * 1000 + 0.25e0 AS budget, '12345678, 8' || CAST(c_custkey AS VARCHAR) AS cpv_codes, CASE WHEN c_custkey % 2 = 0 THEN 2 END AS documents, CASE WHEN c_custkey % 2 = 0 THEN '2026-03-24T00:00:00' END AS formalised FROM customer")
def p6(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    row = lambda tag, *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), c if not isinstance(c, str) else F.lit(c), F.lit(f"</{tag}>")) for c in cells], F.lit("</tr>"))
    pairs = F.concat(F.lit("<dl><dt>Referencia</dt><dd>REF-"), key, F.lit("</dd><dt>Referencia</dt><dd>x</dd><dt>Orzamento base de licitación</dt><dd>"), key, F.lit(".000,25 €</dd></dl>"))
    goods = F.concat(F.lit("<table>"), row("th", "código CPV", "Lote"), row("td", "12345678", "1"), row("td", F.concat(F.lit("8"), key), "2"), row("td", "12345678", "3"), F.lit("</table>"))
    documents = F.concat(F.lit("<dl><dt>Fecha formalización:</dt><dd>24/03/2026</dd></dl><table>"), row("th", "Título", "Fecha", "Estado", "Descarga"), row("td", "a", "b", "c", "d"), row("td", "e", "b", "c", "d"), F.lit("</table>"))
    html = F.concat(F.lit("<title>Detalle procedemento</title>"), pairs, goods, F.when(F.col("c_custkey") % 2 == 0, documents).otherwise(""))
    got = feeds.detail_records(table(spark, sf_dir, "customer").select("c_custkey", html.alias("html")), "c_custkey", "html")
    return got.select("c_custkey", F.col("detail_referencia").alias("referencia"), F.col("detail_presupuesto_base_eur").alias("budget"), F.col("detail_cpv_codes").alias("cpv_codes"), F.col("detail_documentos_count").alias("documents"), F.col("detail_fecha_formalizacion").alias("formalised"))


def _gazettes(spark, sf_dir) -> DataFrame:
    key = F.format_string("%06d", F.col("c_custkey"))
    body = F.concat(F.lit("SECCIÓN PRIMERA\n"), key, F.lit(" - EMPRESA "), key, F.lit(" SL.\nConstitución. Capital: 3.000,00 Euros. Nombramientos. Adm. Unico: PEREZ LOPEZ ANA;GARCIA RUIZ LUIS. Ceses/Dimisiones. Apoderado: SOLO GIL EVA. Datos registrales. T 1.\n"), key, F.lit(" - OTRA "), key, F.lit(" SOCIEDAD ANONIMA. Cambio de domicilio social. C/ NUEVA "), key, F.lit(". Datos registrales. T 41234, L 0, F 12, S 8, H M 567890, I/A 3 (5.01.20).\n"))
    # the table is a small file, its texts are much work: a scan would make one task of them
    return table(spark, sf_dir, "customer").select("c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey").select("c_custkey", body.alias("body"))


@register("p8_gazette_entries", "SELECT c_custkey, 'EMPRESA ' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS empresa_norm, 'Constitución|Ceses/Dimisiones|Nombramientos' AS actos, 3000.0e0 AS capital, CAST(NULL AS VARCHAR) AS domicilio, CAST(NULL AS VARCHAR) AS hoja FROM customer UNION ALL SELECT c_custkey, 'OTRA ' || lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 'Cambio de domicilio|Cambio de domicilio social', NULL, 'C/ NUEVA ' || lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 'M 567890' FROM customer")
def p8(spark, sf_dir):
    return gazette.entries(_gazettes(spark, sf_dir), "c_custkey", "body").select("c_custkey", "empresa_norm", "actos", F.col("capital_euros").alias("capital"), "domicilio", F.col("hoja_registral").alias("hoja"))


@register("p9_officers", "SELECT c_custkey, persona, cargo, tipo_acto FROM customer, (VALUES ('PEREZ LOPEZ ANA', 'Adm. Unico', 'nombramiento'), ('GARCIA RUIZ LUIS', 'Adm. Unico', 'nombramiento'), ('SOLO GIL EVA', 'Apoderado', 'cese')) AS o(persona, cargo, tipo_acto)")
def p9(spark, sf_dir):
    return gazette.officers(gazette.entries(_gazettes(spark, sf_dir), "c_custkey", "body")).select("c_custkey", "persona", "cargo", "tipo_acto")


@register("q17_parser_report", "SELECT measure, value, count(*) AS n FROM customer, (VALUES ('body', 'Constitución'), ('body', 'Cambio'), ('office', 'Adm. Unico'), ('office', 'Adm. Unico'), ('office', 'Apoderado'), ('kind', 'nombramiento'), ('kind', 'nombramiento'), ('kind', 'cese')) AS o(measure, value) GROUP BY 1, 2")
def q17(spark, sf_dir):
    return gazette.parser_report(gazette.entries(_gazettes(spark, sf_dir), "c_custkey", "body")).where("measure != 'missed'")


@register("p5_flatten", "SELECT o_orderkey AS id, o_custkey AS buyer_id, o_orderstatus AS buyer_state_code, CASE WHEN o_orderkey % 2 = 0 THEN '[1,2]' ELSE '[]' END AS tags FROM orders")
def p5(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderstatus").alias("code")).alias("state")).alias("buyer"), F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.expr("cast(array() as array<int>)")).alias("tags"))
    return reshape.flatten(nested)


@register("p22_canonical", "SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS name, CAST(NULL AS VARCHAR) AS none FROM customer WHERE c_custkey % 3 > 0")
def p22(spark, sf_dir):
    """Repeated names made unique, canonical columns from the first source with a value, rows without any value left out."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(key, F.when(key % 2 == 0, F.col("c_name")).alias("a"), F.col("c_mktsegment").alias("a"), F.when(key % 3 > 0, F.lit("x")).alias("told"))
    rows = reshape.informative(reshape.unique_names(rows), ["told"])
    return reshape.canonical(rows, ["id", "name", "none"], {"id": ["c_custkey"], "name": ["a", "a_dup2"]})


# Sources and sinks over files of their own

@register("s4_delimited", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS \"año\", CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def s4(spark, sf_dir):
    """Two kinds of files in one folder, each of its own encoding, separator and header."""
    rows, folder = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("año"), F.col("c_mktsegment").alias("segment"), "c_custkey"), _folder(spark)
    sinks.delimited(rows.where("c_custkey % 2 = 0").drop("c_custkey"), f"{folder}/a")
    rows.where("c_custkey % 2 = 1").select("id", "año").write.option("sep", "§").option("header", "true").option("encoding", "ISO-8859-1").csv(f"{folder}/b")
    return readers.delimited(spark, folder).select("id", "año", "segment")


@register("s10_json", "SELECT o_orderkey AS id, o_orderstatus AS state FROM orders")
def s10(spark, sf_dir):
    """Orders as pages of items of different shapes, read as records."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), (F.col("o_custkey") % 3).alias("shape"), (F.col("o_custkey") % 50).alias("page"))
    pages = rows.groupBy("page", "shape").agg(F.collect_list(F.struct("id", "state")).alias("items"))
    body = F.when(F.col("shape") == 0, F.to_json("items")).when(F.col("shape") == 1, F.to_json(F.struct("items"))).otherwise(F.to_json(F.map_from_entries(F.transform("items", lambda x: F.struct(x["id"].cast("string"), x)))))
    folder = _folder(spark)
    pages.select("page", "shape", body.alias("body")).repartition("page", "shape").write.partitionBy("page", "shape").text(folder)
    got = readers.json_any(spark, folder)
    return got.select(F.try_variant_get("record", "$.id", "long").alias("id"), F.try_variant_get("record", "$.state", "string").alias("state"))


@register("k1_parquet", "SELECT c_custkey, c_mktsegment FROM customer")
def k1(spark, sf_dir):
    """Written by segment without the empty column, read with the columns asked for."""
    folder = _folder(spark)
    sinks.parquet(table(spark, sf_dir, "customer").withColumn("none", F.lit(None).cast("string")), folder, by=["c_mktsegment"], drop_empty=True)
    return readers.parquet(spark, folder, columns=["c_custkey", "c_mktsegment", "none"])


@register("k3_append", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL FROM supplier")
def k3(spark, sf_dir):
    folder = _folder(spark)
    sinks.append(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_acctbal"), folder, ["id", "name"])
    sinks.append(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), folder, ["id", "name"])
    return spark.read.parquet(folder)


@register("k7_summary", "SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_orderstatus', 'string')) AS c(\"column\", type), (SELECT count(*) AS rows, count(*) AS n_values FROM orders)")
def k7(spark, sf_dir):
    return sinks.summary(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))


@register("k9_upsert", "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') = 0 UNION ALL SELECT o_custkey, max(o_orderkey) FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def k9(spark, sf_dir):
    """Open orders as state, those that are done as the batch that takes their place."""
    of = lambda status: table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status).select("o_custkey", "o_orderkey")
    return sinks.upsert(dedupe.keep_last(of("O"), ["o_custkey"], "o_orderkey"), of("F"), ["o_custkey"], "o_orderkey")


@register("k10_manifest", "SELECT CAST(count(*) AS BIGINT) AS files, true AS whole FROM (SELECT DISTINCT c_mktsegment FROM customer)")
def k10(spark, sf_dir):
    """A manifest of written files with their digests, and which of them may be read."""
    folder = _folder(spark)
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", F.to_json(F.struct("c_custkey", "c_name")).alias("j"))
    rows.repartition(1, "c_mktsegment").write.partitionBy("c_mktsegment").text(folder)
    told = sinks.manifest(spark, folder)
    valid = readers.valid_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)).select("path", F.sha2("content", 256).alias("again"))
    return told.join(valid, "path").agg(F.count("*").alias("files"), F.bool_and((F.col("sha256") == F.col("again")) & (F.col("length") > 0)).alias("whole"))


@register("f13_to_do", "SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 4 = 1 AND c_custkey % 6 < 4")
def f13(spark, sf_dir):
    """Customers without state or with retries left."""
    of, key = table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey")
    state = of.where(key % 4 > 0).select("c_custkey", F.when(key % 4 == 1, "retryable").otherwise("done").alias("status"), (key % 6).alias("attempts"))
    return incremental.to_do(of, readers.by_keys(state, of, ["c_custkey"]), ["c_custkey"]).select("c_custkey")


@register("o3_head", "SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1000")
def o3(spark, sf_dir):
    """A sample file's rows: the limit is the feature."""
    return sinks.head(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"]).select("o_orderkey")

