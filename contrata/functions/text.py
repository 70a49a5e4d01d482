"""Names and other text as Column expressions; nothing here leaves generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrata.functions import fixed

ACCENTED, PLAIN = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇ", "AAAAAAEEEEIIIIOOOOOUUUUC"


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def squeeze(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def company_key(name: Column) -> Column:
    """The company name that registers are matched by: no accents (but ñ), parentheses, punctuation or legal forms at its end."""
    x = F.translate(F.trim(F.upper(_text(name))), ACCENTED, PLAIN)
    x = F.regexp_replace(x, r"\s*\([^)]*\)", "")
    for form in fixed.DOTTED_FORMS:
        x = F.regexp_replace(x, r"\b" + r"\s*\.\s*".join(form) + r"\s*\.?\b", form)
    for form in fixed.SPACED_FORMS:
        x = F.regexp_replace(x, r"\b" + r"\s+".join(form) + r"\b", form)
    for form in fixed.FINAL_FORMS:
        x = F.regexp_replace(x, r"\b" + r"\s+".join(form) + r"$", form)
    x = squeeze(F.regexp_replace(x, r"[,.\-]", " "))
    x = F.regexp_replace(x, r"(?:\s+(?:" + "|".join(fixed.LEGAL_FORMS) + r"))+$", "")
    return F.trim(F.regexp_replace(x, r"[.,;]+$", ""))


def company_key_once(name: Column, forms: list[str] = fixed.PARSER_FORMS) -> Column:
    """Upper case, one legal form after a space and then final punctuation away."""
    ends = r"^\s+|\s+$"
    x = F.regexp_replace(F.upper(_text(name)), ends, "")
    x = F.regexp_replace(F.regexp_replace(x, " (?:" + "|".join(forms) + ")$", ""), ends, "")
    return F.regexp_replace(F.regexp_replace(x, "[.,;]+$", ""), ends, "")


def company_key_anywhere(name: Column) -> Column:
    """The quality score's key, which takes legal forms away wherever they stand, inside words as well."""
    x = F.trim(F.upper(_text(name)))
    for form in fixed.QUALITY_FORMS:
        x = F.replace(x, F.lit(form), F.lit(""))
    return squeeze(x)


def buyer_key(name: Column) -> Column:
    """Upper case, eight letters folded, punctuation as spaces."""
    x = F.translate(F.trim(F.upper(_text(name))), "ÁÉÍÓÚÑÜÇ", "AEIOUNUC")
    return squeeze(F.regexp_replace(x, r"[.,;:\-/\\()\[\]\"'`]", " "))


def buyer_key_without_forms(name: Column) -> Column:
    """buyer_key without legal forms at its end."""
    return F.regexp_replace(buyer_key(name), r"(?:\s+(?:S\s?[AL]\s?[UL]?|S\s?M\s?E|M\s?P|E\s?P))+$", "")


def key_words(name: Column, least: int = 4) -> Column:
    """The telling words of a buyer's name."""
    return F.filter(F.split(buyer_key_without_forms(name), " "), lambda w: (F.length(w) >= least) & ~w.isin(fixed.COMMON_WORDS))


def header_key(name: str) -> str:
    """A file's header in canonical form (driver side)."""
    fixed_signs = name.translate(str.maketrans("¢£¡¥", "óúíñ"))
    return re.sub(r"\s+", "_", fixed_signs.strip().lower())


def label_key(label: Column) -> Column:
    """Lower case without accents, other signs as one underscore."""
    x = F.lower(F.translate(F.upper(_text(label)), ACCENTED + "Ñ", PLAIN + "N"))
    return F.regexp_replace(F.regexp_replace(x, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def without_tags(html: Column) -> Column:
    """Text without HTML tags."""
    return squeeze(F.regexp_replace(_text(html), "<[^>]*>", " "))


def known_or_null(x: Column) -> Column:
    """Strings that mean nothing as null."""
    t = F.trim(x.cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "none", "null", "nat", "<na>"), t)


def contract_type(x: Column) -> Column:
    """One spelling of each type."""
    t = F.initcap(F.lower(F.trim(x.cast("string"))))
    return F.when(t.contains("Suministro"), "Suministros").when(t.contains("Servicio"), "Servicios").when(t.contains("Obra"), "Obras").otherwise(t)


def tokens(key: Column, longer_than: int = 2) -> Column:
    """C4: the distinct telling words of a key."""
    return F.array_distinct(F.filter(F.split(key, " "), lambda t: (F.length(t) > longer_than) & ~t.isin(fixed.STOPWORDS)))


def overlap(a: Column, b: Column, least: int = 2) -> Column:
    """Shared tokens as a share of the smaller set; 0 unless there are enough."""
    shared, smaller = F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))
    return F.when((smaller >= least) & (shared >= least), shared / smaller).otherwise(0.0)


def first_scalar(x: Column) -> Column:
    """Of JSON text, a list's first value, an object's first one that isn't empty (its first element, if that is a list), else the value itself; text that is no JSON stays."""
    v = F.try_parse_json(x)
    members = F.transform(F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: F.coalesce(F.try_variant_get(e, "$[0]", "string"), F.when(~F.schema_of_variant(e).startswith("ARRAY"), F.nullif(F.try_variant_get(e, "$", "string"), F.lit("")))))
    kind = F.schema_of_variant(v)
    return F.when(v.isNull(), x).when(kind.startswith("ARRAY"), F.try_variant_get(v, "$[0]", "string")).when(kind.startswith("OBJECT"), F.coalesce(F.get(F.filter(members, lambda m: m.isNotNull()), F.lit(0)), x)).otherwise(F.try_variant_get(v, "$", "string"))


def salted_hash(x: Column, salt: str) -> Column:
    """16 hexadecimal digits of a salted SHA-256; null for nothing."""
    t = F.upper(F.trim(x.cast("string")))
    return F.when(F.length(t) > 0, F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), t).cast("binary"), 256), 1, 16))


def address_tail(x: Column) -> Column:
    """What stands before a parenthesis, its last 80 characters."""
    return F.right(F.trim(F.split_part(_text(x), F.lit("("), F.lit(1))), F.lit(80))


def unique_join(values: Column, by: str = ";") -> Column:
    """Distinct values that aren't empty, in order."""
    return F.array_join(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != ""))), by)


def preferred_language(texts: Column, languages: tuple[str, ...] = ("spa", "SPA", "eng", "ENG")) -> Column:
    """The first text of a map of languages, in order of preference, else of any."""
    first = lambda x: F.get(x, F.lit(0))
    return F.coalesce(*[first(F.try_element_at(texts, F.lit(k))) for k in languages], first(first(F.map_values(texts))))


def record_id(x: Column) -> Column:
    """An id as text, without the decimals of a number."""
    return F.regexp_replace(F.trim(x.cast("string")), r"\.0$", "")


def slug(name: str) -> str:
    """C11: a file name (driver side)."""
    return re.sub(r"[^a-z0-9]+", "-", header_key(name).replace("_", "-")).strip("-")


def contains_any(x: Column, parts: list[str]) -> Column:
    """F8: whether the upper-cased text holds one of the parts; null holds none."""
    return F.coalesce(F.upper(x).rlike("|".join(re.escape(p.upper()) for p in parts)), F.lit(False))


def matches_any(x: Column, patterns: list[str]) -> Column:
    """whether one of the patterns is found, in either case."""
    return F.coalesce(x.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def first_class(x: Column, classes: dict[str, list[str]], otherwise: str | None = None) -> Column:
    """the first class, in order, one of whose parts is in the upper-cased text."""
    out = None
    for name, parts in classes.items():
        hit = contains_any(x, parts)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))
