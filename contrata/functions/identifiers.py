"""Identifiers and codes: cleaning, checksums, validity, code lists and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrata.functions import fixed
from contrata.functions.text import contains_any


def clean_nif(x: Column) -> Column:
    """Upper case without the country's prefix; shorter than 5 is nothing."""
    t = F.regexp_replace(F.upper(F.trim(F.coalesce(x.cast("string"), F.lit("")))), r"^ES[-\s]*", "")
    return F.when(F.length(t) >= 5, t).otherwise("")


def clean_winner_nif(x: Column) -> Column:
    """N8, for winners in notices: the country's prefix goes only from something, and words for nothing are nothing."""
    t = F.regexp_replace(F.upper(F.trim(F.coalesce(x.cast("string"), F.lit("")))), r"^ES[-\s]*(?=[A-Z0-9])", "")
    return F.when(~t.isin("NONE", "NAN", "N/A") & (F.length(t) >= 5), t).otherwise("")


def pick_nif(ids: Column) -> Column:
    """The first of several ids that looks Spanish, else the last."""
    spanish = F.filter(ids, lambda i: (F.length(i) == 9) & (i.rlike("^[A-Za-z]") | i.rlike("[A-Za-z]$")))
    return F.coalesce(F.get(spanish, F.lit(0)), F.get(ids, F.size(ids) - 1))


def _letter(letters: str, at: Column) -> Column:
    return F.substring(F.lit(letters), at + 1, 1)


def valid_nif(x: Column) -> Column:
    """V1: whether a personal, foreigner's or company identifier has its control sign. Null is invalid."""
    raw = F.coalesce(x.cast("string"), F.lit(""))
    s = F.regexp_replace(F.upper(F.trim(raw)), "[-. ]", "")
    last = F.substring(s, 9, 1)

    def person(number: Column) -> Column:
        return last == _letter(fixed.PERSON_LETTERS, (F.expr("0") + number.try_cast("int")) % 23)

    foreign = F.concat(F.translate(F.substring(s, 1, 1), "XYZ", "012"), F.substring(s, 2, 7))
    digit = lambda i: F.substring(s, i, 1).try_cast("int")
    doubled = lambda i: F.when(digit(i) >= 5, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    control = F.pmod(F.lit(10) - F.pmod(sum((digit(i) for i in (5, 7)), digit(3)) + sum((doubled(i) for i in (4, 6, 8)), doubled(2)), F.lit(10)), F.lit(10))
    kind = F.substring(s, 1, 1)
    by_letter, by_digit = last == _letter(fixed.COMPANY_LETTERS, control), last == control.cast("string")
    company = F.when(kind.isin(*"KPQS"), by_letter).when(kind.isin(*"ABEH"), by_digit).otherwise(by_letter | by_digit) & kind.isin(*fixed.COMPANY_TYPES)
    valid = F.when(s.rlike(r"^[0-9]{8}[A-Z]$"), person(F.substring(s, 1, 8))).when(s.rlike(r"^[XYZ][0-9]{7}[A-Z]$"), person(foreign)).when(s.rlike(r"^[A-Z][0-9]{7}[A-Z0-9]$"), company).otherwise(False)
    return F.coalesce(valid & ~raw.contains("@"), F.lit(False))


def _cpv_number(x: Column) -> Column:
    s = F.trim(x.cast("string"))
    return F.regexp_extract(F.regexp_replace(s, r"\.0$", ""), r"^([0-9]{1,18})(?:\.0*)?(?:-.*)?$", 1)


def valid_cpv(x: Column) -> Column:
    """V2: a code of at most 8 digits, leading zeros aside, with or without its check digit."""
    n = F.regexp_replace(_cpv_number(x), "^0+(?=[0-9])", "")
    return F.coalesce((F.length(n) > 0) & (F.length(n) <= 8), F.lit(False))


def cpv_division(x: Column) -> Column:
    """V3: the first two of the eight digits; empty for none."""
    n = F.regexp_replace(_cpv_number(x), "^0+(?=[0-9])", "")
    padded = F.when(F.length(n) > 0, F.when(F.length(n) < 8, F.lpad(n, 8, "0")).otherwise(n)).otherwise(F.trim(x.cast("string")))
    return F.coalesce(F.regexp_extract(padded, "^([0-9]{2})", 1), F.lit(""))


def valid_nuts(x: Column) -> Column:
    """V4."""
    return F.coalesce(F.upper(F.trim(x.cast("string"))).rlike("^ES[0-9A-Z]{0,3}$"), F.lit(False))


def is_utility(buyer: Column) -> Column:
    return contains_any(buyer, fixed.UTILITIES)


def is_state(buyer: Column) -> Column:
    return contains_any(buyer, fixed.STATE) & ~is_utility(buyer)


def threshold(year: Column, kind: Column, state: Column, utility: Column) -> Column:
    """V5: the threshold of a contract; years out of range take the last period's, some types have none."""
    known = F.coalesce(kind.cast("string"), F.lit(""))

    def column(at: int) -> Column:
        out = None
        for row in fixed.THRESHOLDS:
            hit = year.between(row[0], row[1])
            out = F.when(hit, row[at]) if out is None else out.when(hit, row[at])
        return out.otherwise(fixed.THRESHOLDS[-1][at])

    services = F.when(utility, column(5)).when(state, column(3)).otherwise(column(4))
    amount = F.when(known == "Obras", column(2)).when(known.isin("Servicios", "Suministros"), services).otherwise(column(4))
    return F.when(~known.isin(fixed.NO_THRESHOLD), amount).cast("double")


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """A code's label, the code itself where there is none."""
    if not labels:
        return code
    pairs = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return F.coalesce(F.try_element_at(pairs, code.cast("string")), code.cast("string"))
