"""Deduplication with explicit order: exact, by content, first, last, most complete; and reports on duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """D-3, D-4: of each key the row that is first in an order without nulls, or last in one whose nulls are first; ties are broken by the whole row, so results don't depend on partitions. An aggregation: a task keeps one row a key before anything is shuffled, so a hot key is no task's load."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    tie = F.xxhash64(*df.columns)
    best = F.max_by if last else F.min_by
    row = best(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], (F.bitwise_not(tie) if last else tie).alias("tie")))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*[F.col(f"`{c}`") if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return one_per_key(df, keys, [F.col(order).isNull(), F.col(order)])


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return one_per_key(df, keys, [F.col(order)], last=True)


def by_content(df: DataFrame, ids: tuple[str, ...] = ("id",)) -> DataFrame:
    """D-2: distinct in all columns but ids and those that begin with an underscore."""
    return df.dropDuplicates([c for c in df.columns if c not in ids and not c.startswith("_")])


def most_complete(df: DataFrame, keys: list[str], dates: list[str]) -> DataFrame:
    """D-5: of each key the row with most values, then the latest dates."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
    return one_per_key(df, keys, [filled, *[F.col(d) for d in dates]], last=True)


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per other column, the groups of equal keys that have more than one value; with the groups and their rows. One shuffle by key."""
    others = [c for c in df.columns if c not in keys]
    groups = df.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.countDistinct(c).alias(c) for c in others]).where("__n > 1")
    totals = groups.agg(F.count("*").alias("groups"), F.sum("__n").alias("rows"), *[F.count_if(F.col(c) > 1).alias(c) for c in others])
    return totals.select("groups", "rows", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in others]), F.array(*[F.col(c) for c in others]))).alias("column", "differing"))
