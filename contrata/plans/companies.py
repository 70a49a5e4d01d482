"""Company register: anomalies of awards, match rates, anonymised tables and the graph of shared officers (Q11-Q14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrata.functions import text, values
from contrata.operators import graph


def register_facts(companies: DataFrame) -> DataFrame:
    """Per company its first incorporation, last capital, first dissolution and first insolvency, in one aggregation."""
    when = lambda pattern: F.min(F.when(F.coalesce(F.col("actos").rlike(pattern), F.lit(False)), F.col("fecha_borme")))
    return companies.where("empresa_norm is not null and empresa_norm != ''").groupBy("empresa_norm").agg(
        when("Constituci").alias("incorporated"),
        F.max_by("capital_euros", F.when(F.col("capital_euros").isNotNull(), F.col("fecha_borme"))).alias("capital"),
        when("Disolución|Extinción").alias("dissolved"),
        when("(?i)concurso|concursal").alias("insolvent"),
    )


def anomalies(awards: DataFrame, companies: DataFrame) -> DataFrame:
    """Q11: awards with flags: to a company founded 0 to 180 days before, with a capital below 10 000 for more than 100 000, dissolved 0 to 365 days after, or insolvent by then. Unknown is false."""
    rows = awards.withColumn("empresa_norm", text.company_key(F.col("adjudicatario"))).join(register_facts(companies), "empresa_norm", "left")
    no = F.lit(False)
    age, left = values.days_between(F.col("fecha_adjudicacion"), F.col("incorporated")), values.days_between(F.col("dissolved"), F.col("fecha_adjudicacion"))
    return rows.withColumns(
        {
            "days_old": age,
            "new_company": F.coalesce(age.between(0, 180), no),
            "low_capital": F.coalesce((F.col("capital") < 10_000) & (F.col("importe_adjudicacion") > 100_000), no),
            "amount_to_capital": values.ratio(F.col("importe_adjudicacion"), F.col("capital").cast("double")),
            "soon_dissolved": F.coalesce(left.between(0, 365), no),
            "insolvent_before": F.coalesce(F.col("fecha_adjudicacion").cast("date") >= F.col("insolvent").cast("date"), no),
        }
    )


def match_rate(awards: DataFrame, companies: DataFrame) -> DataFrame:
    """Q12: awards whose company is in the register, by rows and by amount."""
    known = companies.where("empresa_norm != ''").select(F.col("empresa_norm").alias("__k")).distinct()
    rows = awards.withColumn("empresa_norm", text.company_key(F.col("adjudicatario"))).join(known, F.col("empresa_norm") == F.col("__k"), "left")
    hit = F.col("__k").isNotNull()
    amount = F.coalesce("importe_adjudicacion", F.lit(0.0))
    return rows.agg(F.count("*").alias("rows"), F.count_if(hit).alias("matched"), values.percent(F.count_if(hit), F.count("*")).alias("rate"), values.percent(F.sum(F.when(hit, amount).otherwise(0.0)), F.sum(amount)).alias("amount_rate"))


def anonymised(officers: DataFrame, salt: str) -> DataFrame:
    """Q13: persons as salted hashes."""
    return officers.withColumn("persona_hash", text.salted_hash(F.col("persona"), salt)).drop("persona")


def without_addresses(companies: DataFrame) -> DataFrame:
    return companies.withColumn("domicilio", text.address_tail(F.col("domicilio")))


def several_companies(officers: DataFrame) -> DataFrame:
    """Persons in more than one company."""
    return officers.where("persona_hash is not null").groupBy("persona_hash").agg(F.countDistinct("empresa_norm").alias("n_companies")).where("n_companies > 1")


def officer_graph(officers: DataFrame) -> DataFrame:
    """Q14: companies by the appointed persons that they share."""
    return graph.co_membership(officers.where("tipo_acto = 'nombramiento'"), "persona_hash", "empresa_norm")
