"""Contract quality: indicators with three values, and the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.functions import fixed, identifiers, text, values
from contrata.operators import graph, windows


def _yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def is_minor(df: DataFrame) -> Column:
    out = F.lit(False)
    if "conjunto" in df.columns:
        out = out | _yes(F.lower("conjunto") == "menores")
    if "procedimiento" in df.columns:
        out = out | _yes(F.lower("procedimiento").contains("menor"))
    return out


def with_indicators(df: DataFrame) -> DataFrame:
    """df with the base indicators that its columns allow, true, false or null; and es_menor. One pass, and one for all group percentiles."""
    have = set(df.columns)
    pick = lambda *names: next((n for n in names if n in have), None)
    amount = {c: values.number(F.col(c)) for c in ("importe_sin_iva", "importe_con_iva", "importe_adjudicacion", "importe_adj_con_iva") if c in have}
    tender, award = pick("importe_sin_iva", "importe_con_iva"), pick("importe_adjudicacion", "importe_adj_con_iva")
    none = F.lit(None).cast("boolean")
    out: dict[str, Column] = {}
    out["val_01"] = amount[tender].isNotNull() if tender else none
    out["val_02"] = amount[award].isNotNull() if award else none
    some = [_yes(a >= fixed.LEAST_AMOUNT) for a in amount.values()]
    missing = [a.isNull() for a in amount.values()]
    out["val_03"] = _any(some) | _all(missing) if amount else none
    offers = values.number(F.col("num_ofertas")) if "num_ofertas" in have else None
    out["val_04"] = offers.isNull() | (offers % 1 == 0) if offers is not None else none
    out["val_05"] = offers.isNull() | (offers >= 0) if offers is not None else none
    dates = {c: F.col(c).try_cast("timestamp") for c in ("fecha_publicacion", "fecha_adjudicacion", "fecha_limite") if c in have}
    for name, c in (("val_06", "fecha_publicacion"), ("val_07", "fecha_adjudicacion")):
        out[name] = _yes(dates[c].between(F.lit(fixed.FIRST_DATE).cast("timestamp"), F.lit(fixed.LAST_DATE).cast("timestamp"))) if c in have else none
    out["val_09"] = identifiers.valid_cpv(F.col("cpv_principal")) if "cpv_principal" in have else none
    place = pick("nuts", "ubicacion")
    out["val_10"] = identifiers.valid_nuts(F.col(place)) if place else none
    out["val_12"] = identifiers.valid_nif(F.col("nif_adjudicatario")) if "nif_adjudicatario" in have else none
    minor, paid = is_minor(df), pick("importe_adjudicacion", "importe_sin_iva")
    if "tipo_contrato" in have and paid:
        limit = F.when(_yes(F.lower("tipo_contrato").contains("obra")), fixed.MINOR_WORKS).otherwise(fixed.MINOR_OTHER)
        out["val_14"] = ~minor | amount[paid].isNull() | (amount[paid] <= limit)
    else:
        out["val_14"] = none
    if "estado" in have and offers is not None:
        out["cons_01"] = ~_yes(F.lower("estado").rlike("adjud|formaliz|resuel")) | _yes(offers >= 1)
    else:
        out["cons_01"] = none
    pair = next(((a, b) for a, b in (("importe_sin_iva", "importe_adjudicacion"), ("importe_con_iva", "importe_adj_con_iva")) if a in have and b in have), None)
    out["cons_08"] = _yes(~(amount[pair[0]] > 0) | (amount[pair[1]] <= amount[pair[0]] * (1 + fixed.AWARD_TOLERANCE))) | amount[pair[0]].isNull() | amount[pair[1]].isNull() if pair else none
    if {"fecha_publicacion", "fecha_limite"} <= have:
        out["fia_04"] = F.coalesce(values.days_between(dates["fecha_limite"], dates["fecha_publicacion"]).between(0, fixed.MOST_DAYS), F.lit(True))
    else:
        out["fia_04"] = none
    out["fia_08"] = amount[tender].isNull() | (amount[tender] <= fixed.MOST_BUDGET) if tender else none
    has = lambda c: F.col(c).isNotNull() if c in have else F.lit(False)
    out["fia_11"] = has("expediente") & (has("url") | has("id"))
    df = df.withColumns({**out, "es_menor": minor})
    grouped, wanted, temporary = "cpv_principal" in have, {}, {}
    if offers is not None:
        temporary["__offers"], wanted["__offers_99"] = offers, ("__offers", 0.99)
    if award:
        temporary["__award"] = amount[award]
        wanted |= {"__award_01": ("__award", 0.01), "__award_99": ("__award", 0.99)}
    if grouped and wanted:
        df = df.withColumns({"__division": identifiers.cpv_division(F.col("cpv_principal")), **temporary})
        df = windows.with_group_percentiles(df, ["__division"], wanted)
    if offers is not None:
        fine = offers.isNull() | offers.between(0, fixed.MOST_OFFERS)
        df = df.withColumn("fia_01", fine & (offers.isNull() | (offers <= F.coalesce("__offers_99", F.lit(float(fixed.MOST_OFFERS))))) if grouped else fine)
    if award and grouped:
        df = df.withColumn("fia_09", F.when(F.col("__award") > 0, F.col("__award").between(F.col("__award_01"), F.col("__award_99"))).otherwise(True))
    df = df.withColumns({c: none for c in ("fia_01", "fia_09") if c not in df.columns})
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _any(xs: list[Column]) -> Column:
    out = F.lit(False)
    for x in xs:
        out = out | x
    return out


def _all(xs: list[Column]) -> Column:
    out = F.lit(True)
    for x in xs:
        out = out & x
    return out


INDICATORS = ["val_01", "val_02", "val_03", "val_04", "val_05", "val_06", "val_07", "val_09", "val_10", "val_12", "val_14", "cons_01", "cons_08", "fia_01", "fia_04", "fia_08", "fia_09", "fia_11"]


def with_cross_checks(df: DataFrame, crossval: DataFrame, companies: DataFrame) -> DataFrame:
    """Q2: cons_20, whether a contract above the threshold was found abroad (the last row of its file and winner counts), and cons_18, whether a company's name is in the register."""
    df = graph.lookup_last(df, crossval.withColumnRenamed("found", "cons_20"), ["expediente", "nif_adjudicatario"], "cons_20", "row_ord")
    key = text.company_key_anywhere(F.col("adjudicatario"))
    kind = F.upper(F.trim(F.coalesce(F.col("nif_adjudicatario").cast("string"), F.lit(""))))
    return graph.exists_in(df, companies.select(text.company_key_anywhere(F.col("empresa")).alias("name")), key, "name", kind.rlike("^[A-HJ-NP-SUVW]") & (key != ""), "cons_18")


def with_score(df: DataFrame, indicators: list[str] | None = None) -> DataFrame:
    """Q3: the share of true among the indicators that aren't null, in percent, rounded half to even; null if all are."""
    indicators = indicators or [c for c in [*INDICATORS, "cons_18", "cons_20"] if c in df.columns]
    told = sum((F.col(c).isNotNull().cast("int") for c in indicators), F.lit(0))
    true = sum((_yes(F.col(c)).cast("int") for c in indicators), F.lit(0))
    return df.withColumn("score_calidad", F.when(told > 0, F.bround(true / told * 100, 1)))


def failure_report(df: DataFrame, indicators: list[str]) -> DataFrame:
    """Per indicator, rows evaluated and failed, and the failing shares of minor and other contracts; one aggregation, however many indicators."""
    each = df.select("es_menor", F.explode(F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).alias("ok")) for c in indicators])).alias("i")).where("i.ok is not null")
    share = lambda cond: F.bround(100.0 * F.count_if(cond & ~F.col("i.ok")) / F.nullif(F.count_if(cond), F.lit(0)), 1)
    return each.groupBy(F.col("i.indicator").alias("indicator")).agg(F.count("*").alias("evaluated"), F.count_if(~F.col("i.ok")).alias("failed"), share(F.col("es_menor")).alias("failed_minor"), share(~F.col("es_menor")).alias("failed_other"))
