"""The health sector's contracts: profile, patterns of lots, kinds of goods, and coverage that counts lots once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.functions import fixed, text, values

#: Labels of groups that are published as one notice.
AS_ONE = ["lotes_mismo_expediente", "acuerdo_marco_homogeneo"]
BUYER, AMOUNT = "organo_contratante", "importe_adjudicacion"


def is_health(buyer: Column) -> Column:
    """whether a buyer's name fits one of the sector's patterns."""
    return F.coalesce(F.upper(buyer).rlike("|".join(f"(?:{p})" for p in fixed.HEALTH)), F.lit(False))


def region(buyer: Column) -> Column:
    """the first region one of whose parts is in the upper-cased name."""
    return text.first_class(buyer, fixed.REGIONS, "Otros")


def lot_patterns(missing: DataFrame, keys: tuple[str, str] = (BUYER, "ano")) -> DataFrame:
    """Missing contracts by buyer and year, with a label for how these were bought; the aggregation is partial before its shuffle."""
    rows = missing.where(" and ".join(f"{k} is not null" for k in keys))
    of = rows.groupBy(*keys).agg(F.count(AMOUNT).alias("n"), F.countDistinct("nif_adjudicatario").alias("n_winners"), F.sum(AMOUNT).alias("total"), F.avg(AMOUNT).alias("mean"), F.percentile(AMOUNT, 0.5).alias("median"), F.stddev_samp(AMOUNT).alias("std"), F.countDistinct("expediente").alias("n_files"))
    of = of.withColumns({"files_share": F.col("n_files") / F.greatest("n", F.lit(1)), "variation": F.col("std") / F.greatest("mean", F.lit(1.0))})
    many, few_files = F.col("n") >= 5, F.col("files_share") < 0.3
    label = F.when(many & few_files, "lotes_mismo_expediente").when(many & (F.col("variation") < 0.5), "acuerdo_marco_homogeneo").when(many & (F.col("variation") >= 0.5), "contratos_recurrentes").when((F.col("n") >= 2) & (F.col("n") < 5), "grupo_pequeno").otherwise("individual")
    return of.withColumn("pattern", label)


def pattern_totals(patterns: DataFrame) -> DataFrame:
    """Groups, contracts and amounts by label."""
    return patterns.groupBy("pattern").agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_contracts"), F.sum("total").alias("total"))


def profile(rows: DataFrame, by: list[str]) -> DataFrame:
    """Q10: contracts, matched, missing, the share matched and the amount, by the columns given: buyers, types, kinds of goods, regions, or none for the whole."""
    of = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("is_matched").alias("n_matched"), F.count_if("missing").alias("n_missing"), F.sum(AMOUNT).alias("total"))
    return of.withColumn("rate", values.percent(F.col("n_matched"), F.col("n")))


def by_goods(rows: DataFrame, digits: int = 2, within: str | None = None) -> DataFrame:
    """Q10: profile by the first digits of the goods' code; within: only codes that begin so."""
    code = F.substring(F.coalesce(F.col("cpv_principal").cast("string"), F.lit("")), 1, digits)
    coded = rows.withColumn("goods", code)
    return profile(coded.where(F.col("goods").startswith(within)) if within else coded, ["goods"])


def matched_against_missing(rows: DataFrame) -> DataFrame:
    """Q10: mean and median amounts, shares of types and of bands of amounts, of matched and of missing contracts; one aggregation."""
    sides = {"matched": F.col("is_matched"), "missing": F.col("missing")}
    amount, columns = F.col(AMOUNT), []
    for name, hit in sides.items():
        n = F.greatest(F.count_if(hit), F.lit(1))
        share = lambda condition, hit=hit, n=n: F.bround(100.0 * F.count_if(hit & F.coalesce(condition, F.lit(False))) / n, 1)
        measures = {"mean": F.avg(F.when(hit, amount)), "median": F.percentile(F.when(hit, amount), F.lit(0.5))}
        measures |= {f"share_{t.lower()}": share(F.col("tipo_contrato") == t) for t in ("Servicios", "Suministros", "Obras")}
        measures |= {f"share_{i}": share((amount >= lo) & (amount < hi)) for i, (lo, hi) in enumerate(fixed.HEALTH_BANDS)}
        columns.append(F.struct(F.lit(name).alias("side"), F.count_if(hit).alias("n"), *[c.alias(k) for k, c in measures.items()]))
    return rows.agg(F.array(*columns).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def strategies(rows: DataFrame) -> DataFrame:
    """Q10: how matched contracts were found."""
    return rows.where("is_matched").groupBy("strategy").agg(F.count("*").alias("n"))


def adjusted_coverage(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Matched, missing and coverage, if each group that was bought as one counts once. Two rows of scalars meet."""
    lots = patterns.agg(F.count_if(F.col("pattern").isin(AS_ONE)).alias("n_groups"), F.coalesce(F.sum(F.when(F.col("pattern").isin(AS_ONE), F.col("n"))), F.lit(0)).alias("in_groups"))
    counts = rows.agg(F.count_if("is_matched").alias("matched"), F.count_if("missing").alias("missing")).join(lots)
    total = F.col("matched") + F.col("missing") - F.col("in_groups") + F.col("n_groups")
    return counts.withColumn("adjusted_total", total).withColumn("coverage", F.bround(100.0 * F.col("matched") / F.greatest(total, F.lit(1)), 1))
