"""Group percentiles, gap sessions, concentration and carried values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrata.functions import values
from contrata.operators.cut import cut


def group_percentiles(df: DataFrame, group: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Per group, exact interpolated percentiles; wanted: name to (column, share). One pass over df for all of them.

    Equal values of a group are counted first, so what goes on is distinct values, dealt by group and value. Counts by
    bucket of values tell the buckets that hold the wanted ranks, and only those buckets' values are put in order: no task
    has a group's values, however large the group.
    """
    g = [f"g{i}" for i in range(len(group))]
    each = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in dict.fromkeys(c for c, _ in wanted.values())])
    long = df.select(*[F.col(k).alias(n) for k, n in zip(group, g, strict=True)], F.explode(each).alias("v")).select(*g, "v.c", "v.x").where("x is not null")
    counts = cut(long.groupBy(*g, "c", "x").agg(F.count("*").alias("n")).withColumn("bucket", values.order_bucket(F.col("x"))))
    w = Window.partitionBy(*g, "c")
    buckets = counts.groupBy(*g, "c", "bucket").agg(F.sum("n").alias("n"))
    buckets = buckets.withColumns({"before": F.sum("n").over(w.orderBy("bucket")) - F.col("n"), "rows": F.sum("n").over(w)})
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c).alias("of"), F.lit(float(share)).alias("share")) for name, (c, share) in wanted.items()])
    asked = buckets.withColumn("r", F.explode(ranks)).where("r.of = c").withColumn("place", (F.col("rows") - 1) * F.col("r.share"))
    asked = asked.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place"))))).where("rank >= before and rank < before + n")
    asked = asked.select(*[F.col(k).alias(f"a{k}") for k in g], F.col("c").alias("ac"), F.col("bucket").alias("ab"), "before", "place", "rank", F.col("r.name").alias("name"))
    on = [F.col(k).eqNullSafe(F.col(f"a{k}")) for k in g]
    inside = counts.join(asked, [*on, F.col("c") == F.col("ac"), F.col("bucket") == F.col("ab")])
    last = F.sum("n").over(Window.partitionBy(*g, "name", "rank").orderBy("x")) + F.col("before")
    found = inside.withColumn("last", last).where("rank < last and rank >= last - n")
    ends = found.groupBy(*g, "name").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.first("place").alias("place"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise((F.ceil("place") - F.col("place")) * F.col("lo") + (F.col("place") - F.floor("place")) * F.col("hi"))
    told = ends.groupBy(*g).agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in wanted])
    return told.select(*[F.col(n).alias(k) for k, n in zip(group, g, strict=True)], *wanted)


def with_group_percentiles(df: DataFrame, group: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """group_percentiles beside each row."""
    of = group_percentiles(df, group, wanted).select(*[F.col(k).alias(f"__{k}") for k in group], *wanted)
    return df.join(of, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in group], "left").drop(*[f"__{k}" for k in group])


def with_percentiles(df: DataFrame, group: list[str], value: str, **shares: float) -> DataFrame:
    """Exact interpolated percentiles of one column by group, beside its rows."""
    return with_group_percentiles(df, group, {name: (value, share) for name, share in shares.items()})


def sessions(df: DataFrame, key: str, at: str, gap: Column | float, name: str = "session", least: int = 2) -> DataFrame:
    """Numbers of runs of a key's rows whose distance is at most the gap (in the unit of `at`); runs of fewer rows than `least`, and rows without a time, have -1."""
    w = Window.partitionBy(key).orderBy(at)
    timed = df.where(F.col(at).isNotNull() & F.col(key).isNotNull())
    marked = timed.withColumn("__new", F.coalesce((F.col(at) - F.lag(at).over(w) > gap).cast("int"), F.lit(1)))
    run = marked.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sized = run.withColumn("__n", F.count("*").over(Window.partitionBy(key, "__run")))
    out = sized.withColumn(name, F.when(F.col("__n") >= least, F.col("__run")).otherwise(-1).cast("long")).drop("__new", "__run", "__n")
    rest = df.where(F.col(at).isNull() | F.col(key).isNull()).withColumn(name, F.lit(-1).cast("long"))
    return out.unionByName(rest)


def concentration(df: DataFrame, key: str, value: str, share: float = 0.5) -> DataFrame:
    """The largest keys that together have at most a share of the sum. Sums per key come first; buckets of sums, 256 for each doubling, are offset by those before and put in order one by one, so no task sees all keys."""
    sums = df.groupBy(key).agg(F.sum(value).alias("total")).where(F.col(key).isNotNull())
    buckets = sums.withColumn("__b", F.coalesce(values.order_bucket(F.col("total").cast("double")), F.lit(-(1 << 40))))
    by_bucket = buckets.groupBy("__b").agg(F.sum("total").alias("__s"))
    before = by_bucket.select("__b", (F.sum("__s").over(Window.orderBy(F.col("__b").desc())) - F.col("__s")).alias("__before"), F.sum("__s").over(Window.partitionBy()).alias("__all"))
    ranked = buckets.join(F.broadcast(before), "__b")
    w = Window.partitionBy("__b").orderBy(F.col("total").desc(), key).rowsBetween(Window.unboundedPreceding, 0)
    # divided as doubles: a quotient of decimals keeps six digits, which takes keys a little above the share
    running = ranked.withColumn("running_share", (F.sum("total").over(w) + F.col("__before")).cast("double") / F.col("__all").cast("double"))
    return running.where(F.col("running_share") <= share).drop("__b", "__before", "__all")


def carried(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The last value seen so far in a key's order."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))
