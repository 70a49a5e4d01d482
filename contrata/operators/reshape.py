"""Flattening, unions of differing schemas, column pruning and pivots; decided from schemas, before any row is read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """P5: nested structs as columns a_b; arrays and maps as JSON text."""

    def leaves(schema: T.StructType, at: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            path = [*at, f.name]
            column = F.col(".".join(f"`{p}`" for p in path))
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, path)
            else:
                out.append((F.to_json(column) if isinstance(f.dataType, T.ArrayType | T.MapType) else column).alias(separator.join(path)))
        return out

    return df.select(leaves(df.schema, []))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows and all columns, null where a frame has none; columns whose types differ become text first."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {name for name, of in kinds.items() if len(of) > 1}
    same = [df.withColumns({n: F.col(n).cast("string") for n in df.columns if n in mixed}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


def unique_names(df: DataFrame) -> DataFrame:
    """Repeated column names get _dup2, _dup3 and so on."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        seen[c] = seen.get(c, 0) + 1
        names.append(c if seen[c] == 1 else f"{c}_dup{seen[c]}")
    return df.toDF(*names)


def first_of_names(df: DataFrame) -> DataFrame:
    """Of repeated column names the first."""
    numbered = df.toDF(*[f"{i}" for i in range(len(df.columns))])
    first = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    return numbered.select(*[F.col(f"`{i}`").alias(c) for c, i in sorted(first.items(), key=lambda x: x[1])])


def without_empty_columns(df: DataFrame) -> DataFrame:
    """K8: without columns that are null throughout; one aggregation finds them."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


def informative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in one of the columns."""
    return df.dropna("all", subset=[c for c in columns if c in df.columns])


def canonical(df: DataFrame, columns: list[str], sources: dict[str, list[str]]) -> DataFrame:
    """The canonical columns, each the first value of its sources, null without any."""
    own = set(df.columns)
    return df.select(*[F.coalesce(*found).alias(c) if (found := [F.col(f"`{s}`").cast("string") for s in sources.get(c, [c]) if s in own]) else F.lit(None).cast("string").alias(c) for c in columns])


def lots(notices: DataFrame, ids: str, arrays: list[str], fallbacks: dict[str, list[str]]) -> DataFrame:
    """A row for each lot of a notice with parallel arrays; an array that is too short gives its last element, empty strings count as none, and a column with fallbacks takes the first of these."""
    n = F.greatest(*[F.coalesce(F.size(a), F.lit(0)) for a in arrays], F.lit(1))
    rows = notices.withColumn("lot_index", F.explode(F.sequence(F.lit(0), n - 1)))
    at = lambda a: F.nullif(F.coalesce(F.get(a, F.col("lot_index")), F.get(a, F.size(a) - 1)), F.lit(""))
    return rows.select(ids, "lot_index", *[at(a).alias(a) for a in arrays if a not in fallbacks], *[F.coalesce(*[at(s) for s in of]).alias(name) for name, of in fallbacks.items()])


def category_totals(df: DataFrame, category: str, measures: dict[str, str], otherwise: str) -> DataFrame:
    """Per category, the sum of the column that counts for it."""
    measure = F.col(otherwise)
    for name, column in measures.items():
        measure = F.when(F.col(category) == name, F.col(column)).otherwise(measure)
    return df.groupBy(category).agg(F.sum(measure).alias("total"))


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of a column's values as columns; the values are given, so no pass collects them."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1)))
