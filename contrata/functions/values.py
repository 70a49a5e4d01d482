"""Numbers and dates out of text, and arithmetic that keeps its nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(x: Column) -> Column:
    """A number as text or value; anything else, and NaN, is null."""
    t = F.trim(x.cast("string"))
    return F.when(t.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), t.try_cast("double"))


def spanish_number(x: Column) -> Column:
    """M1: the first run of digits and separators, points for thousands and a comma for decimals."""
    run = F.regexp_extract(F.coalesce(x.cast("string"), F.lit("")), r"([-0-9.,]+)", 1)
    return number(F.replace(F.replace(run, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def mixed_number(x: Column) -> Column:
    """M2: Spanish if there are both separators, a decimal comma if there is only that, else as it is."""
    t = F.regexp_replace(x.cast("string"), "[€?\u0080\\s]", "")
    return number(F.when(t.contains(",") & t.contains("."), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(t, F.lit(","), F.lit("."))))


def first_amount(*amounts: Column) -> Column:
    """M4: the first amount above zero."""
    return F.coalesce(*[F.when(a > 0, a) for a in amounts])


def notice_amount(award: Column, value: Column, total: Column, estimated: Column) -> Column:
    """M4: a notice's amount: the award's, else the tender's, else the whole notice's, else what was estimated."""
    return F.coalesce(*[number(x) for x in (award, value, total, estimated)])


def match_amount(award: Column, budget: Column) -> Column:
    """M4: a contract's amount for matching: the award's if it is above zero, else the budget's."""
    return F.when(number(award) > 0, number(award)).otherwise(number(budget))


def order_bucket(x: Column) -> Column:
    """Whole numbers in the order of the values, 256 for each doubling; equal values share one."""
    size = lambda a: F.floor(F.log2(a) * 256) + (1 << 20)
    return F.when(x > 0, size(x)).when(x < 0, -size(-x)).otherwise(0).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """M5: null if there is nothing to divide by."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """M6, M7: a share in percent, rounded half to even; of nothing, 0."""
    return F.bround(100.0 * part / F.greatest(whole, F.lit(1)), digits)


_DAY_FIRST = ["d/M/yyyy H:m:s", "d/M/yyyy H:m", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy"]


def timestamp(x: Column) -> Column:
    """T1f, T3f, T6f: ISO first, its zone dropped, else day first; null if neither."""
    t = F.regexp_replace(F.trim(x.cast("string")), r"(:[0-9]{2}(?:\.[0-9]+)?)(?:Z|[+-][0-9]{2}:?[0-9]{2})$", "$1")
    t = F.regexp_replace(t, r"\+[0-9]{2}:?[0-9]{2}$", "")
    iso = t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    first = F.when(iso, F.coalesce(F.try_to_timestamp(F.replace(t, F.lit("T"), F.lit(" "))), F.try_to_timestamp(F.substring(t, 1, 10))))
    return F.coalesce(first, *[F.when(~iso, F.try_to_timestamp(t, F.lit(f))) for f in _DAY_FIRST])


def iso_text(x: Column) -> Column:
    """T2f: a date's text in ISO form; empty for none."""
    return F.coalesce(F.date_format(timestamp(x), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def day_prefix(x: Column) -> Column:
    """T2f: the first ten characters; empty for null."""
    return F.coalesce(F.substring(x.cast("string"), 1, 10), F.lit(""))


def year_of(*dates: Column, name: Column | None = None) -> Column:
    """T4f: the year of the first date there is, else one in a file's name or a notice's id."""
    years = [F.year(d) for d in dates]
    if name is not None:
        years += [F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("int") for pattern in (r"-([0-9]{4})$", r"(20[0-9]{2})")]
    return F.coalesce(*years)


def days_between(end: Column, start: Column) -> Column:
    """T5f: whole days, rounded down."""
    return F.floor((F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / 86_400).cast("int")


def period(day: Column, months_from: int) -> Column:
    """A1: the period of publication that a day belongs to: its year, from a year on its year and month."""
    return F.when(F.year(day) < months_from, F.date_format(day, "yyyy")).otherwise(F.date_format(day, "yyyyMM"))
