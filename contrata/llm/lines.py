"""Line dedup by overlapping three-line windows, with DataFrame functions alone.

Each document's consecutive lines (split at \\n) are hashed three at a time. So that a long passage is found beside edited
neighbours and in short documents too, a line of more than LONG words, and two lines that have so many only together, are
windows of their own. A window that occurs more than once stays at its first occurrence, the one with the smallest
(doc_id, hash of the text, line); the lines that its later occurrences cover are removed, overlapping ones merged. Each
removed line so has an earlier equal line that stays.

Plan: windows become rows of two hashes and a place, counted with map-side partial aggregation, and only windows that
repeat meet their group's first place again; those that more than one in common.MOST_HOT rows have are dealt to many
tasks, with a copy of that place each. Places return to their own row only.

Cases: fewer than three lines and no long passage, an empty or null text: nothing is removed (null text: stays null). Very
long text: as any other. A window of blank lines is never a repetition. Rows that share a doc_id but not their text are
documents of their own; equal rows are at the same place, so neither is later than the other, and what one has to remove
both do. Null doc_id: windows are seen, as the earliest, and nothing is removed. Extra columns, whatever their names, stay
as they are, but `_n_lines` and `_n_kept` give way to those of the result. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.llm import common

WIDTH = 3
LONG = 50
WORD = r"[^\x20\x09-\x0D]+"


def _own(docs: DataFrame) -> DataFrame:
    """doc_id and key (a hash of the text) of each row, and in `row` all its columns, where their names meet no others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_said(F.col("text"))).alias("key"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _said(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _windows(own: DataFrame) -> DataFrame:
    """(doc_id, key, place, width, h1, h2) of every window that isn't blank."""
    lines = own.select("doc_id", "key", _lines(_said(F.col("row")["text"])).alias("lines"))
    lines = lines.withColumn("words", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))))
    line, words = lambda i: F.get("lines", i), lambda i: F.get("words", i)

    def hashed(i: Column, width: int) -> Column:
        parts = [line(i + k) for k in range(width)]
        return F.struct(i.alias("place"), F.lit(width).alias("width"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("h2"))

    def full(i: Column) -> Column:
        return F.when(F.length(F.trim(F.concat(*[line(i + k) for k in range(WIDTH)]))) > 0, hashed(i, WIDTH))

    def short(i: Column) -> Column:
        together = (words(i) <= LONG) & (words(i + 1) <= LONG) & (words(i) + words(i + 1) > LONG)
        return F.when(words(i) > LONG, hashed(i, 1)).when(together, hashed(i, 2))

    places = F.sequence(F.lit(0), F.size("lines") - 1)
    threes = F.transform(F.slice(places, F.lit(1), F.greatest(F.size("lines") - (WIDTH - 1), F.lit(0))), full)
    windows = F.concat(threes, F.filter(F.transform(places, short), lambda w: w.isNotNull()))
    return lines.select("doc_id", "key", F.explode(windows).alias("w")).where("w is not null").select("doc_id", "key", "w.*")


def covered_places(own: DataFrame) -> DataFrame:
    """(doc_id, key, places): the first lines and widths of the windows to remove from each document that has any."""
    windows, place = _windows(own), F.struct("doc_id", "key", "place")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = common.Scratch(own.sparkSession).keep(first)
    met = common.looked_up(windows, first, ["h1", "h2"], "first", "n")
    later = met.where(F.col("doc_id").isNotNull() & (place > F.col("first")))
    return later.groupBy("doc_id", "key").agg(F.collect_set(F.struct("place", "width")).alias("places"))


def _kept(docs: DataFrame) -> DataFrame:
    """row, text (of the lines that stay; null if nothing is removed), n_lines and n_kept."""
    own = _own(docs)
    gone = covered_places(own).toDF("gone_id", "gone_key", "places")
    joined = own.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left").withColumn("lines", _lines(_said(F.col("row")["text"])))
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p["place"], p["place"] + p["width"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered)
    text = F.when(F.col("places").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    n_kept = F.when(F.col("places").isNull(), F.size("lines")).otherwise(F.size(kept))
    return joined.select("row", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), n_kept.cast("long").alias("n_kept"))


def _field(c: str) -> Column:
    return F.col("row")[c]


def line_dedup(docs: DataFrame) -> DataFrame:
    """docs with all its columns and rows, its text without the covered lines, and beside these `_n_lines` and `_n_kept`."""
    counts = {"_n_lines": F.col("n_lines"), "_n_kept": F.col("n_kept")}
    text = F.coalesce("text", _field("text").cast("string"))
    return _kept(docs).select(*[(text if c == "text" else _field(c)).alias(c) for c in docs.columns if c not in counts], *[of.alias(c) for c, of in counts.items()])


def deduplicated(docs: DataFrame, keep_emptied: bool = True) -> DataFrame:
    """docs, with n_chars (if there is one) set to the length of the text that is left; without the rows that removing left with white space alone, if these aren't kept."""
    kept = _kept(docs)
    if not keep_emptied:
        kept = kept.where(F.col("text").isNull() | F.col("text").rlike(r"\S"))
    text = F.coalesce("text", _field("text").cast("string"))
    n_chars = F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return kept.select(*[(text if c == "text" else n_chars if c == "n_chars" else _field(c)).alias(c) for c in docs.columns])
