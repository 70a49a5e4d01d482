"""Column layouts of delimited files, decided on the driver from headers and first lines."""

from __future__ import annotations

import re

from contrata.functions.text import header_key


def squashed(name: str) -> str:
    return re.sub(r"[\s_]+", "", header_key(name))


def header_row(lines: list[list[str]], most: int = 6) -> int:
    """The first line, after at most so many title lines, that has several cells with letters and no number; -1: there is none."""
    for i, cells in enumerate(lines[: most + 2]):
        full = [c for c in cells if c and c.strip()]
        if len(full) >= 2 and all(re.search("[A-Za-zÀ-ÿ]", c) for c in full) and len(full) >= 0.5 * len(cells):
            return i
    return -1


def detect(header: list[str], layouts: dict[str, list[str]]) -> str | None:
    """The layout with most of its columns in the header, if it has all of them."""
    have = {squashed(h) for h in header}
    fits = {name: len(columns) for name, columns in layouts.items() if all(squashed(c) in have for c in columns)}
    return max(fits, key=lambda n: (fits[n], n)) if fits else None


def direct(header: list[str], names: dict[str, str]) -> dict[str, str]:
    """Header column to canonical name, by equal names but for case and spaces; the first column of a name has it."""
    by = {squashed(k): v for k, v in names.items()}
    out: dict[str, str] = {}
    for h in header:
        target = by.get(squashed(h))
        if target and target not in out.values():
            out[h] = target
    return out


def by_keywords(header: list[str], keywords: dict[str, list[tuple[str, ...]]], taken: dict[str, str]) -> dict[str, str]:
    """Columns whose name holds all words of one of a target's tuples; more and longer words win, then the first column."""
    out = dict(taken)
    for target, choices in keywords.items():
        if target in out.values():
            continue
        best, column = 0, None
        for h in header:
            if h in out:
                continue
            key = header_key(h)
            score = max((10 * len(words) + sum(map(len, words)) for words in choices if all(w in key for w in words)), default=0)
            if score > best:
                best, column = score, h
        if column:
            out[column] = target
    return out


def by_order(header: list[str], patterns: list[tuple[str, str]], taken: dict[str, str]) -> dict[str, str]:
    """Patterns in order, the most telling first; each column and each target is given once, what is taken stays."""
    out = dict(taken)
    for pattern, target in patterns:
        if target in out.values():
            continue
        hit = next((h for h in header if h not in out and re.search(pattern, header_key(h))), None)
        if hit:
            out[hit] = target
    return out


def positional(first: list[str], layouts: list[tuple[str, list[str]]]) -> list[str]:
    """P20: names for a file without a header: of the first layout whose pattern the first cell fits."""
    cell = (first[0] if first else "").strip()
    for pattern, names in layouts:
        if re.search(pattern, cell):
            return names
    return [f"unnamed:_{i}" for i in range(len(first))]


def numeric_columns(header: list[str], words: str = "importe|valor|precio|presupuesto|canon|iva") -> list[str]:
    return [h for h in header if re.search(words, header_key(h))]


def date_columns(header: list[str], words: str = "fecha|date|data") -> list[str]:
    return [h for h in header if re.search(words, header_key(h))]
