"""Contracts above the EU threshold, their matching with published notices, and reports on both (Q4-Q9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.functions import fixed, identifiers, text, values
from contrata.operators import matching
from contrata.operators.cut import cut

#: Subsets and types that aren't subject to publication.
SUBSETS_OUT = ["menores", "encargos", "consultas"]
TYPES_OUT = ["Privado", "Patrimonial", "Administrativo Especial", "22", "999", "32"]


def _award_steps(contracts: DataFrame) -> dict[str, Column]:
    """The conditions of F1-F3 in their order."""
    amount = values.number(F.col("importe_adjudicacion")).isNotNull() | values.number(F.col("importe_sin_iva")).isNotNull()
    real = (F.col("tipo_registro") == "LICITACION") & F.col("estado").isin("Resuelta", "Adjudicada") & F.col("nif_adjudicatario").isNotNull() & amount
    steps = {"awards": F.coalesce(real, F.lit(False))}
    steps |= {subset: F.coalesce(F.col("conjunto") != subset, F.lit(True)) for subset in SUBSETS_OUT}
    steps["types"] = ~F.coalesce(F.col("tipo_contrato").cast("string"), F.lit("")).isin(TYPES_OUT)
    steps["years"] = F.coalesce(F.col("ano").between(2010, 2027), F.lit(False))
    return steps


def awarded(contracts: DataFrame) -> DataFrame:
    """Awarded contracts with a winner and any amount, without the subsets and types that aren't published, 2010 to 2027."""
    for condition in _award_steps(contracts).values():
        contracts = contracts.where(condition)
    return contracts


def award_report(contracts: DataFrame) -> DataFrame:
    """how many rows each condition of `awarded` takes away from what those before it left; one aggregation."""
    before, counts = F.lit(True), []
    for name, condition in _award_steps(contracts).items():
        counts.append(F.count_if(before & ~condition).alias(name))
        before = before & condition
    return contracts.agg(F.count("*").alias("rows"), *counts, F.count_if(before).alias("kept"))


def classified(contracts: DataFrame) -> DataFrame:
    """Q4: threshold, is_sara (by its own amount or by that of its file's lots together) and sara_by_lots."""
    utility, state = identifiers.is_utility(F.col("dependencia")), identifiers.is_state(F.col("dependencia"))
    amount = F.coalesce(values.number(F.col("importe_sin_iva")), values.number(F.col("importe_adjudicacion")))
    rows = contracts.withColumns({"amount": amount, "threshold": identifiers.threshold(F.col("ano"), F.col("tipo_contrato"), state, utility)})
    rows = rows.withColumn("is_individual", F.coalesce(F.col("amount") >= F.col("threshold"), F.lit(False)))
    return promoted(rows)


def promoted(rows: DataFrame, file: str = "expediente") -> DataFrame:
    """G1: lots of a file that reach the lowest threshold together. The aggregation is partial before its shuffle; rows get it back by a join on the file."""
    lots = rows.where(F.col(file).isNotNull() & F.col("threshold").isNotNull()).groupBy(file).agg(F.sum("amount").alias("lots_sum"), F.count("amount").alias("n_lots"), F.min("threshold").alias("lots_threshold"))
    lots = lots.where((F.col("n_lots") >= 2) & (F.col("lots_sum") >= F.col("lots_threshold")))
    out = rows.join(lots.select(file, "lots_sum", "n_lots"), file, "left")
    by_lots = F.col("lots_sum").isNotNull() & ~F.col("is_individual") & F.col("threshold").isNotNull()
    return out.withColumn("sara_by_lots", by_lots).withColumn("is_sara", F.col("is_individual") | F.col("sara_by_lots"))


def _grouped_choice(all_: Column) -> Column:
    """Of the free candidates in year order, the nearest; those by name count only in the first year that has any, and there only if none goes by number."""
    step = F.array_min(F.transform(all_, lambda c: c["step"]))
    numbered = F.exists(all_, lambda c: (c["step"] == step) & (c["by_name"] == 0))
    pool = F.filter(all_, lambda c: (c["by_name"] == 0) | ((c["step"] == step) & ~numbered))
    return F.array_min(F.transform(pool, lambda c: F.struct(c["diff"].alias("diff"), c["step"].alias("step"), c["by_name"].alias("by_name"), c["right_ord"].alias("right_ord"))))


def matched(left: DataFrame, right: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Q5: left_ord, right_ord, strategy and diff of every match, strategy by strategy, each on what the ones before left.

    left: left_ord, nif, nif_organo, organo, expediente, year, amount, is_sara, sara_by_lots, neg_sin_pub.
    right: right_ord, notice_id, win_nif, cae_nif, cae_name, internal_id, year, amount, total_value, estimated_value.
    aliases: organo, alias (both normalised, 40 characters).
    """
    short = lambda c: F.substring(text.buyer_key(F.col(c)), 1, 40)
    left = cut(left.withColumns({"nif": identifiers.clean_nif(F.col("nif")), "nif_organo": identifiers.clean_nif(F.col("nif_organo")), "name": short("organo"), "file": F.upper(F.trim(F.coalesce("expediente", F.lit("")))), "tokens": text.tokens(text.buyer_key(F.col("organo")), 3), "words": text.tokens(text.buyer_key(F.col("organo")))}).where("is_sara"))
    right = cut(right.withColumns({"nif": identifiers.clean_nif(F.col("win_nif")), "nif_organo": identifiers.clean_nif(F.col("cae_nif")), "name": short("cae_name"), "file": F.upper(F.trim(F.coalesce("internal_id", F.lit("")))), "tokens": text.tokens(text.buyer_key(F.col("cae_name")), 3), "words": text.tokens(text.buyer_key(F.col("cae_name")))}))

    # E1 and E2 share their notices: one call, the winner's number before the file
    file = F.when(F.length("file") >= 4, F.col("file"))
    found = matching.assign(left, right, [(F.col("nif"), F.col("nif"), [0, 1, -1]), (file, F.col("file"), None)])
    found = found.select("left_ord", "right_ord", F.when(F.col("tier") == 1, "E1").otherwise("E2").alias("strategy"), "diff")

    # The lots of a file take its first free notice, all the same one
    lots = left.where(F.col("sara_by_lots") & (F.length("file") >= 4)).join(found.select("left_ord"), "left_ord", "left_anti")
    free = right.join(found.select("right_ord"), "right_ord", "left_anti")
    of_file = free.where("file != ''").groupBy("file").agg(F.min("right_ord").alias("right_ord"))
    found = cut(found.unionByName(lots.join(of_file, "file").select("left_ord", "right_ord", F.lit("E2b").alias("strategy"), F.lit(None).cast("double").alias("diff"))))

    def remaining() -> tuple[DataFrame, DataFrame]:
        """What later strategies may use: a notice is used up with all its rows."""
        used = found.join(right.select("right_ord", "notice_id"), "right_ord").select("notice_id").distinct()
        return left.where(~F.coalesce("neg_sin_pub", F.lit(False))).join(found.select("left_ord"), "left_ord", "left_anti"), right.join(used, "notice_id", "left_anti").join(found.select("right_ord"), "right_ord", "left_anti")

    def add(new: DataFrame, name: str) -> None:
        nonlocal found
        found = cut(found.unionByName(new.select("left_ord", "right_ord", F.lit(name).alias("strategy"), "diff")))

    open_, free = remaining()
    add(matching.assign(open_, free, [(F.col("nif_organo"), F.col("nif_organo"), [0, -1, 1])]), "E3")

    # A buyer's year as one amount, against any of a notice's three
    open_, free = remaining()
    groups = open_.where(F.col("organo").isNotNull() & (F.col("amount") > 0)).groupBy("organo", "year").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"), F.min_by("nif_organo", "left_ord").alias("nif_organo"), F.min_by("name", "left_ord").alias("name")).where("n >= 2")
    groups = cut(groups.withColumn("left_ord", F.xxhash64("organo", "year")).withColumn("place", F.struct("organo", "year")))
    any_amount = free.select("right_ord", "nif_organo", "name", "year", F.explode(F.array_distinct(F.filter(F.array("total_value", "estimated_value", "amount"), lambda a: a > 0))).alias("amount"))
    by_number = matching.near_amounts(groups, any_amount, "nif_organo", [0, -1, 1], fixed.WIDE_TOLERANCE).withColumn("by_name", F.lit(0))
    by_name = matching.near_amounts(groups, any_amount, "name", [0, -1, 1], fixed.WIDE_TOLERANCE).withColumn("by_name", F.lit(1))
    pairs = by_number.unionByName(by_name).groupBy("left_ord", "right_ord", "step", "by_name").agg(F.min("diff").alias("diff"))
    # groups go in the order of buyer and year
    ordered = pairs.join(groups.select("left_ord", "place"), "left_ord").drop("left_ord").withColumnRenamed("place", "left_ord")
    won = matching.greedy(ordered, ["diff", "step", "by_name"], choose=_grouped_choice)
    rows = open_.where("amount > 0").join(won.select(F.col("left_ord.organo").alias("organo"), F.col("left_ord.year").alias("year"), "right_ord", "diff"), ["organo", "year"])
    found = cut(found.unionByName(rows.select("left_ord", "right_ord", F.lit("E4").alias("strategy"), "diff")))

    open_, free = remaining()
    add(matching.assign(open_.where("length(name) >= 6"), free, [(F.col("name"), F.col("name"), [0, -1, 1])]), "E5")
    if aliases is not None:
        open_, free = remaining()
        named = open_.join(aliases.select(F.col("organo").alias("name"), "alias"), "name").drop("name").withColumnRenamed("alias", "name")
        pairs = matching.near_amounts(named, free, "name", [0, -1, 1]).groupBy("left_ord", "right_ord").agg(F.min(F.struct("diff", "step")).alias("d")).select("left_ord", "right_ord", "d.*")
        add(matching.greedy(pairs, ["diff", "step"]), "E3b")
    open_, free = remaining()
    # candidates share a word of more than three letters; the overlap counts those of more than two
    alike = matching.near_words(open_.where("length(name) >= 12 and size(tokens) >= 3"), free.where("length(name) > 10"), "tokens", "words", 0.6, 3)
    add(matching.greedy(alike.withColumn("step", F.lit(0)), ["diff", "step"]), "E7")

    # The other lots of a file that has a match
    rest = left.join(found.select("left_ord", "right_ord"), "left_ord", "left").withColumn("matched", F.col("right_ord").isNotNull())
    more = matching.spread(rest, "file", "matched", "right_ord", "left_ord").where("spread")
    return found.unionByName(more.select("left_ord", "right_ord", F.lit("E6").alias("strategy"), F.lit(None).cast("double").alias("diff")))


def with_matches(left: DataFrame, found: DataFrame) -> DataFrame:
    """Q6: is_matched, strategy, missing (not negotiated without publicity) and missing_all."""
    out = left.join(found.select("left_ord", "right_ord", "strategy"), "left_ord", "left").withColumn("is_matched", F.col("strategy").isNotNull())
    gone = F.col("is_sara") & ~F.col("is_matched")
    return out.withColumn("missing_all", gone).withColumn("missing", gone & ~F.coalesce("neg_sin_pub", F.lit(False)))


def high_confidence(rows: DataFrame, buyers: DataFrame, amount: float = 221_000) -> DataFrame:
    """Q6: missing contracts of buyers that publish, from 2016, above the amount."""
    seen = buyers.where("nif_organo != ''").select("nif_organo").distinct()
    return rows.where(F.col("missing") & (F.col("year") >= 2016) & (F.col("amount") >= amount)).join(seen, "nif_organo", "left_semi")


def by_year(rows: DataFrame, notices: DataFrame) -> DataFrame:
    """Contracts above the threshold, matched, missing, their rate, and their ratio to notices."""
    own = rows.where("is_sara").groupBy("year").agg(F.count("*").alias("sara"), F.count_if("is_matched").alias("matched"), F.count_if("missing").alias("missing"))
    other = notices.groupBy("year").agg(F.count("*").alias("notices"))
    return own.join(other, "year", "left").select("year", "sara", "matched", "missing", values.percent(F.col("matched"), F.col("sara")).alias("rate"), F.bround(F.col("sara") / F.nullif("notices", F.lit(0)), 2).alias("ratio"))


def by_file(rows: DataFrame) -> DataFrame:
    """Q7: files, and those with a match."""
    files = rows.where("is_sara and expediente is not null").groupBy("expediente").agg(F.bool_or("is_matched").alias("any_match"), F.sum("amount").alias("amount"))
    return files.agg(F.count("*").alias("files"), F.count_if("any_match").alias("matched"), F.sum(F.when(F.col("any_match"), F.col("amount"))).alias("matched_amount"))


def bands(rows: DataFrame, amount: str, edges: list[float]) -> DataFrame:
    """Rows by half-open band of amount."""
    band = None
    for lo, hi in zip(edges, [*edges[1:], float("inf")], strict=True):
        hit = (F.col(amount) >= lo) & (F.col(amount) < hi)
        band = F.when(hit, lo) if band is None else band.when(hit, lo)
    return rows.withColumn("band", band).where("band is not null").groupBy("band").agg(F.count("*").alias("n"), F.sum(amount).alias("total"))


def at_least(rows: DataFrame, amount: str, limits: list[float]) -> DataFrame:
    """Rows from each limit on; one aggregation."""
    counts = rows.agg(*[F.count_if(F.col(amount) >= x).alias(f"n{i}") for i, x in enumerate(limits)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(float(x)).alias("least"), F.col(f"n{i}").alias("n")) for i, x in enumerate(limits)])).alias("r")).select("r.*")


def diagnosis(rows: DataFrame, buyer: str = "organo_contratante", amount: str = "importe_adjudicacion") -> DataFrame:
    """Q9: missing contracts with the overlapping reasons to doubt them: a buyer that no matched contract has, years before 2016, an amount between the lowest and the highest of the thresholds for services; whether their buyer's year has five or more of them, which may be lots of one notice; and sure, for those of buyers with matches, from 2016 and above all thresholds."""
    seen = rows.where("is_matched").where(F.col(buyer).isNotNull()).select(F.col(buyer).alias("__b")).distinct()
    out = rows.where("missing").join(seen, F.col(buyer) == F.col("__b"), "left").withColumn("buyer_seen", F.col("__b").isNotNull()).drop("__b")
    groups = out.where(F.col(buyer).isNotNull() & F.col("year").isNotNull()).groupBy(F.col(buyer).alias("__b"), F.col("year").alias("__y")).agg(F.count("expediente").alias("__n"))
    out = out.join(groups, (F.col(buyer) == F.col("__b")) & (F.col("year") == F.col("__y")), "left")
    no = F.lit(False)
    early, grey = F.coalesce(F.col("year").between(2010, 2015), no), F.coalesce((F.col(amount) >= 139_000) & (F.col(amount) < 221_000), no)
    sure = F.col("buyer_seen") & F.coalesce((F.col("year") >= 2016) & (F.col(amount) >= 221_000), no)
    return out.withColumns({"early": early, "grey": grey, "many": F.coalesce(F.col("__n") >= 5, no), "sure": sure}).drop("__b", "__y", "__n")


def diagnosis_report(diagnosed: DataFrame) -> DataFrame:
    """Q9: the classes' sizes and shares of all missing contracts; they overlap."""
    n = F.count("*")
    counts = {"buyer_unseen": F.count_if(~F.col("buyer_seen")), "early": F.count_if("early"), "grey": F.count_if("grey"), "many": F.count_if("many"), "sure": F.count_if("sure")}
    one = diagnosed.agg(n.alias("missing"), *[c.alias(k) for k, c in counts.items()])
    each = [F.struct(F.lit(k).alias("class"), F.col(k).alias("n"), values.percent(F.col(k), F.col("missing")).alias("share")) for k in counts]
    return one.select("missing", F.explode(F.array(*each)).alias("c")).select("missing", "c.*")


def recoverable(rows: DataFrame, notices: DataFrame, key: str, limits: tuple[float, float] = (0.15, 10_000.0)) -> DataFrame:
    """Q9: missing contracts that a wider tolerance finds a notice for, by the buyer's name or number: each, in order, the first free one of its own year, the year before or after. left_ord, right_ord. All rows are tried, so nothing is extrapolated."""
    return matching.assign(rows, notices, [(F.col(key), F.col(key), [0, -1, 1])], limits, first=True).select("left_ord", "right_ord")


def coverage_by_year(rows: DataFrame, notices: DataFrame) -> DataFrame:
    """Q9: contracts above the threshold by year, matched and missing, the share missing, and notices for each contract."""
    own = rows.where("is_sara").where(F.col("year").between(2010, 2026)).groupBy("year").agg(F.count("*").alias("sara"), F.count_if("is_matched").alias("matched"), F.count_if("missing").alias("missing"))
    out = own.join(notices.groupBy("year").agg(F.count("*").alias("notices")), "year", "left").withColumn("notices", F.coalesce("notices", F.lit(0)))
    return out.withColumns({"share_missing": values.percent(F.col("missing"), F.col("sara")), "ratio": F.bround(F.col("notices") / F.greatest("sara", F.lit(1)), 2)})


#: The lowest threshold, which the simple validation uses for all contracts.
LEAST_THRESHOLD = 140_000.0


def simple_validation(contracts: DataFrame, notices: DataFrame) -> DataFrame:
    """Q8: contracts from the lowest threshold on against notices: by the winner's number, else by the file, each notice once; with validated, strategy, missing (not minor, 2010 to 2025) and excess over the threshold.

    contracts: left_ord, nif, expediente, year, amount, is_minor. notices: right_ord, win_nif, internal_id, year, amount.
    """
    left = contracts.withColumns({"nif": identifiers.clean_nif(F.col("nif")), "file": F.upper(F.trim(F.coalesce("expediente", F.lit(""))))})
    right = notices.withColumns({"nif": identifiers.clean_nif(F.col("win_nif")), "file": F.upper(F.trim(F.coalesce("internal_id", F.lit(""))))})
    over = left.where((F.col("amount") >= LEAST_THRESHOLD) & (F.length("nif") >= 5) & F.col("year").isNotNull())
    file = F.when(F.length("file") >= 4, F.col("file"))
    found = matching.assign(over, right, [(F.col("nif"), F.col("nif"), [0, 1, -1]), (file, file, None)])
    out = left.join(found.select("left_ord", "right_ord", F.when(F.col("tier") == 1, "nif").otherwise("file").alias("strategy")), "left_ord", "left")
    validated = F.col("strategy").isNotNull()
    missing = F.coalesce((F.col("amount") >= LEAST_THRESHOLD) & F.col("year").between(2010, 2025), F.lit(False)) & ~validated & ~F.coalesce("is_minor", F.lit(False))
    return out.withColumns({"validated": validated, "missing": missing, "excess": F.when(missing, F.col("amount") - LEAST_THRESHOLD)})


def notice_indicators(rows: DataFrame, entity: str) -> DataFrame:
    """Per buyer or winner, the share of its contracts above the lowest threshold that are missing, if it has three of them at least, and the share of all that are validated."""
    over = F.count_if(F.coalesce(F.col("amount") >= LEAST_THRESHOLD, F.lit(False)))
    of = rows.groupBy(entity).agg(F.count("*").alias("n"), over.alias("n_over"), F.count_if("missing").alias("n_missing"), F.count_if("validated").alias("n_validated"))
    enough = F.col("n_over") >= 3
    share = lambda a, b: 100.0 * F.col(a) / F.col(b)
    return of.select(entity, "n_validated", share("n_validated", "n").alias("share_validated"), F.when(enough, F.col("n_over")).alias("n_over"), F.when(enough, F.col("n_missing")).alias("n_missing"), F.when(enough, share("n_missing", "n_over")).alias("share_missing"))
