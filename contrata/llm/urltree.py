"""URL filters by a path-template tree.

Per host, paths become templates: segments that are numbers, hashes, dates or the like are wildcards at once; a level
with very many different children for its number of pages becomes a wildcard too. Sibling branches whose labelled share
of good pages doesn't differ from that of all siblings together, by a test of proportions, are merged. A template is
rejected if its smoothed purity (labelled good pages, shrunk towards the host's share, and that towards the share of
all) is below LEAST_PURITY. Explicit rules go first; the longest that fits wins.

Pages are aggregated to (host, segments) before anything else, so a hot host costs its distinct paths, and all later
steps are aggregations and joins of these. Pages meet their template again by one join on these two. Paths are taken at
their whole depth: one pass over hashes of all prefixes finds the next level that has something to generalise or merge,
so that steps are made for these levels alone, however deep the paths are. Joins on a host, a branch or a path that very
many rows have deal these to many tasks (common.looked_up).

Cases: null url or one without `://`: empty host and path, which have a template like any other. No labels: the method
allows all. Several labels of a page: the worse counts. Repeated rows and null page_ids: a row each. Very long urls: as
any other. Extra columns, whatever their names: left out. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.llm import common

#: A level is variable with more children than this, and fewer than so many pages to a child.
CHILDREN, PAGES_A_CHILD = 30, 5
Z = 1.96
#: Labelled pages that the share above counts for.
SMOOTHING = 4.0
LEAST_PURITY = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VARIABLE = r"^(\d+|\d{4}-\d{2}(-\d{2})?|(?=[0-9a-f]*\d)[0-9a-f]{8,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[^.]*\d{4,}[^.]*)(\.[a-z]{1,5})?$"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def segments_of(path: Column) -> Column:
    own = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(own, lambda s: F.when(F.lower(s).rlike(_VARIABLE), F.concat(F.lit("*"), F.regexp_extract(F.lower(s), r"(\.[a-z]{1,5})$", 1))).otherwise(s))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(length, rule, action) of the longest rule that fits; rules: (action, host/path), a configuration that is part of the plan."""
    fits = []
    for action, rule in rules:
        name, slash, rest = rule.partition("/")
        fit = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,action:string>")


def _replaced(at: int, by: Column) -> Column:
    return F.transform("segments", lambda s, i: F.when(i == at, by).otherwise(s))


def _places(tree: DataFrame) -> DataFrame:
    """tree once for each place of its segments: d, and the rest."""
    return tree.where(F.size("segments") > 0).select("*", F.explode(F.sequence(F.lit(0), F.size("segments") - 1)).alias("d"))


def _next_wide(tree: DataFrame, first: int) -> int | None:
    """The first level from one on that has a variable branch."""
    prefixes = _places(tree).where(F.col("d") >= first).select("host", "d", F.xxhash64(F.expr("slice(segments, 1, d)")).alias("prefix"), F.get("segments", F.col("d")).alias("child"), "n")
    own = prefixes.groupBy("host", "d", "prefix", "child").agg(F.sum("n").alias("n")).groupBy("host", "d", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("pages"))
    return own.where((F.col("children") > CHILDREN) & (F.col("pages") < PAGES_A_CHILD * F.col("children"))).agg(F.min("d")).first()[0]


def _last_with_siblings(tree: DataFrame, below: int | None) -> int | None:
    """The last level before one where branches differ in that segment alone."""
    places = _places(tree).where(~F.get("segments", F.col("d")).startswith("*"))
    places = places if below is None else places.where(F.col("d") < below)
    pools = places.select("host", "d", F.xxhash64(F.transform("segments", lambda s, i: F.when(i == F.col("d"), F.lit("+")).otherwise(s))).alias("pool"), F.get("segments", F.col("d")).alias("child"))
    return pools.groupBy("host", "d", "pool").agg(F.min("child").alias("a"), F.max("child").alias("b")).where("a < b").agg(F.max("d")).first()[0]


def templates(urls: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(host, key, template, purity): of each host's distinct segments (key), the template and its purity. urls: host, key (array of segments) and good (1, 0 or null)."""
    stats = [F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("labelled").alias("labelled")]
    tree = urls.groupBy("host", "key").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"), F.count("good").cast("double").alias("labelled"))
    tree = scratch.keep(tree.withColumn("segments", F.col("key")))
    d = -1
    while (d := _next_wide(tree, d + 1)) is not None:
        prefixed = tree.withColumn("prefix", F.slice("segments", 1, d))
        own = prefixed.where(F.size("segments") > d).groupBy("host", "prefix", F.get("segments", F.lit(d)).alias("child")).agg(F.sum("n").alias("n"))
        wide = own.groupBy("host", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("pages"))
        wide = wide.where((F.col("children") > CHILDREN) & (F.col("pages") < PAGES_A_CHILD * F.col("children"))).select("host", "prefix", F.lit(True).alias("wide"))
        marked = common.looked_up(prefixed, wide, ["host", "prefix"], "wide", how="left")
        tree, old = scratch.keep(marked.withColumn("segments", F.when(F.col("wide") & (F.size("segments") > d), _replaced(d, F.lit("*"))).otherwise(F.col("segments"))).drop("prefix", "wide")), tree
        scratch.drop(old)
    d = None
    while (d := _last_with_siblings(tree, d)) is not None:
        # a branch is a template; its siblings differ from it in one segment that isn't a wildcard
        branch = tree.groupBy("host", "segments").agg(*stats).where(F.size("segments") > d).where(~F.get("segments", F.lit(d)).startswith("*"))
        branch = branch.withColumn("pool", _replaced(d, F.lit("+")))
        pool = branch.groupBy("host", "pool").agg(F.sum("good").alias("all_good"), F.sum("labelled").alias("all_labelled"), F.count("*").alias("branches")).where("branches > 1")
        pool = pool.select("host", "pool", F.struct("all_good", "all_labelled").alias("all"))
        p = F.col("all.all_good") / F.nullif(F.col("all.all_labelled"), F.lit(0.0))
        alike = (F.col("labelled") == 0) | (F.abs(F.col("good") / F.nullif("labelled", F.lit(0.0)) - p) <= Z * F.sqrt(p * (1 - p) / F.nullif("labelled", F.lit(0.0))))
        branch = scratch.keep(branch)
        merged = common.looked_up(branch, pool, ["host", "pool"], "all").where(alike).select("host", "segments", "pool")
        joined = common.looked_up(tree, merged, ["host", "segments"], "pool", how="left")
        tree, old = scratch.keep(joined.withColumn("segments", F.coalesce("pool", "segments")).drop("pool")), tree
        scratch.drop(old, branch)
    whole = tree.agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled")).first()
    share = (whole.good or 0.0) / whole.labelled if whole.labelled else 1.0
    hosts = tree.groupBy("host").agg(((F.sum("good") + SMOOTHING * share) / (F.sum("labelled") + SMOOTHING)).alias("host_share"))
    of = common.looked_up(scratch.keep(tree.groupBy("host", "segments").agg(*stats)), hosts, ["host"], "host_share")
    purity = (F.col("good") + SMOOTHING * F.col("host_share")) / (F.col("labelled") + SMOOTHING)
    pure = common.looked_up(tree.select("host", "key", "segments"), of.select("host", "segments", purity.alias("purity")), ["host", "segments"], "purity")
    return pure.select("host", "key", F.concat(F.lit("/"), F.array_join("segments", "/")).alias("template"), "purity")


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Per row of pages (page_id, url): page_id, host, path, rule, verdict, template, purity. labelled: page_id and good (1 or 0)."""
    scratch = common.Scratch(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = scratch.keep(rows.withColumn("key", segments_of(F.col("path"))))
    good = labelled.groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.min("good").alias("good"))
    found = scratch.keep(templates(rows.join(good, "page_id", "left").select("host", "key", "good"), scratch))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    joined = common.looked_up(rows, found.select("host", "key", F.struct("template", "purity").alias("of")), ["host", "key"], "of", how="left").select("*", "of.*").withColumn("fit", rule)
    by_method = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.action", by_method).alias("verdict"), "template", "purity")
