"""Regional consolidation: tables of differing layouts as one of canonical columns (Q15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrata.functions import text, values
from contrata.operators import reshape
from contrata.sources import layouts


def mapped(header: list[str], names: dict[str, str], keywords: dict[str, list[tuple[str, ...]]], patterns: list[tuple[str, str]]) -> dict[str, str]:
    """Column to canonical name: by equal names, then by patterns in order, then by words; what one step gave the next ones leave."""
    return layouts.by_keywords(header, keywords, layouts.by_order(header, patterns, layouts.direct(header, names)))


def consolidated(frames: dict[str, DataFrame], columns: list[str], names: dict[str, str], keywords: dict[str, list[tuple[str, ...]]], patterns: list[tuple[str, str]]) -> DataFrame:
    """All frames' rows under the canonical columns and `source`, the frame's name: repeated headers made unique, columns mapped, words for nothing null, numbers and dates read, rows without a value and repetitions left out.

    The mapping is decided from headers alone; rows pass once, and one shuffle finds the repetitions.
    """
    numeric, dates = layouts.numeric_columns(columns), layouts.date_columns(columns)
    parts = []
    for source, df in frames.items():
        df = reshape.unique_names(df)
        found = mapped(df.columns, names, keywords, patterns)
        rows = reshape.canonical(df, columns, {target: [column] for column, target in found.items()} | {c: [] for c in columns if c not in found.values()})
        rows = rows.withColumns({c: values.mixed_number(F.col(c)) if c in numeric else values.timestamp(F.col(c)) if c in dates else text.known_or_null(F.col(c)) for c in columns})
        parts.append(reshape.informative(rows, columns).withColumn("source", F.lit(source)))
    return reshape.union_all(parts).distinct()
