"""Graphs of companies by the people they share, and table lookups that keep three values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def co_membership(members: DataFrame, person: str, company: str, least: int = 2, most: int = 20) -> DataFrame:
    """(company_a, company_b, n_shared, shared) of companies with a person in common, a before b. Persons in more than `most` companies join none, which is part of the result's meaning and bounds a person's pairs."""
    pairs = members.where(F.col(person).isNotNull() & F.col(company).isNotNull()).select(F.col(person).alias("p"), F.col(company).alias("c")).distinct()
    counts = pairs.groupBy("p").agg(F.count("*").alias("n")).where(F.col("n").between(least, most)).select("p")
    degree = pairs.join(counts, "p", "left_semi").groupBy("p").agg(F.sort_array(F.collect_set("c")).alias("all"))
    ends = degree.select("p", "all", F.posexplode("all").alias("i", "company_a"))
    edges = ends.select("p", "company_a", F.explode(F.slice("all", F.col("i") + 2, F.lit(most))).alias("company_b"))
    return edges.groupBy("company_a", "company_b").agg(F.count("*").alias("n_shared"), F.array_join(F.sort_array(F.collect_set("p")), ",").alias("shared"))


def lookup_last(left: DataFrame, right: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value of the last of the right rows with the same keys; nulls are a key of their own."""
    of = right.groupBy(*[F.coalesce(F.col(k).cast("string"), F.lit("nan")).alias(f"__{k}") for k in keys]).agg(F.max_by(value, order).alias(value))
    on = [F.coalesce(left[k].cast("string"), F.lit("nan")) == of[f"__{k}"] for k in keys]
    return left.join(of, on, "left").drop(*[f"__{k}" for k in keys])


def exists_in(left: DataFrame, right: DataFrame, key: Column, right_key: str, evaluable: Column, name: str) -> DataFrame:
    """Whether the key is on the right; null where that can't be told."""
    seen = right.where(F.col(right_key).isNotNull()).select(F.col(right_key).alias("__seen")).distinct()
    joined = left.withColumn("__key", key).join(seen, F.col("__key") == F.col("__seen"), "left")
    return joined.withColumn(name, F.when(evaluable, F.col("__seen").isNotNull())).drop("__key", "__seen")


def with_details(base: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """Details beside their rows, `detail_status` missing where there are none."""
    return base.join(details, keys, "left").withColumn("detail_status", F.coalesce("detail_status", F.lit("missing")))
