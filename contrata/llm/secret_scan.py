"""Secret scans with a recursive decoding worklist.

Each text is scanned by the base patterns. Encoded regions in it (percent escapes, Unicode escapes, base64, hexadecimal
and zlib or gzip streams inside these) are unwrapped into layers, each layer is scanned and unwrapped in its turn, until
no layer gives a new one. A layer that was seen before, by the hash of its content, isn't taken up again, so cycles and
repeated parts end. A finding in a layer is mapped to the span of the original text whose decoding it lies in: each
character that an escape stands for has the place of that escape, other encodings have the place of the whole region.
An escape that stands for no character stays as it is, and those around it are decoded all the same.

Decoded bytes are scanned whole, whatever stands among them: what isn't UTF-8 is replaced, UTF-16 parts and compressed
streams are taken out wherever they begin. Base64 and hexadecimal runs are read line by line, and joined where only a line
break parts them (a finding across lines has the place of all of them); base64 is read from each of four places, as text
may be glued to it. Bytes without a printable run of LEAST_RUN characters, which any finding has, are left.

A stream is decompressed to its end, whatever it expands to, in windows of WINDOW bytes that overlap by OVERLAP, and one
window a layer is in memory. A finding is shorter than the overlap, or has enough of itself in a window, so none is lost
between two. Only a stream or a region of base64 inside a stream of more than WINDOW bytes can lie across its windows;
what it holds up to the window's end and what its rest shows by itself is found.

Cases: null or empty text: no findings. Very long text: scanned whole. Equal texts: equal findings. Repeated rows: a row
each. Null doc_id: carried along. Extra columns, whatever their names: left out. Empty table: no rows. Positions count
code points, end exclusive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import groupby, pairwise
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.llm import common

#: Bytes of a decompressed stream that are a layer, and those that two of its layers share.
WINDOW, OVERLAP = 32 << 20, 1 << 20
LEAST_RUN = 16
KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_HEXES = re.compile(r"(?:[0-9a-fA-F]{2}){16,}")
_BREAK = re.compile(r"[ \t]*\r?\n[ \t>]*")
#: The short last line of a run over lines.
_BASE64_END = re.compile(r"[ \t]*\r?\n[ \t>]*([A-Za-z0-9+/_-]{1,15}={0,2})(?=[ \t]*(?:\r?\n|$))")
_HEXES_END = re.compile(r"[ \t]*\r?\n[ \t>]*((?:[0-9a-fA-F]{2}){1,15})(?=[ \t]*(?:\r?\n|$))")
_RUN = re.compile(rb"[\t\n\r -~]{%d}" % LEAST_RUN)
_WIDE = re.compile(rb"(?:[\t\n\r -~]\x00){%d,}[ -~]?" % (LEAST_RUN - 1))
_STREAM = re.compile(rb"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78]")
#: Bytes in URL form: what needs no escape, and escapes.
_QUOTED = re.compile(r"[A-Za-z0-9_.~/+*!'()%-]+")
_FEED = 1 << 16


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, leftmost and without overlap per kind. The two kinds of a single class of characters take whole runs, so a run that is too short can be left out by the pattern itself."""
    out = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A text and where it comes from: runs (first index in the text; place in the original and how many characters each of the run's has there, or the place of them all), or one region for all."""

    def __init__(self, text: str, region: tuple[int, int] | None = None, starts: list[int] | None = None, places: list[tuple[int, int, int]] | None = None):
        self.text, self.region, self.starts, self.places = text, region, starts, places

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.region:
            return self.region
        if self.starts is None:
            return start, end
        return self._place(start)[0], self._place(max(start, end - 1))[1]

    def _place(self, i: int) -> tuple[int, int]:
        """The original span of one character."""
        at = bisect.bisect_right(self.starts, i) - 1
        first, last, step = self.places[at]
        return (first + step * (i - self.starts[at]), first + step * (i - self.starts[at] + 1)) if step else (first, last)


class Blob:
    """Decoded bytes of a region."""

    def __init__(self, data: bytes, region: tuple[int, int]):
        self.data, self.region = data, region


def _with_escapes(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer's text with all the pattern's escapes decoded; None if there are none. decode: of a match, pieces (text, from, to) of equally wide escapes."""
    parts, starts, places, at, n = [], [], [], 0, 0

    def add(text: str, first: int, last: int, step: int) -> None:
        nonlocal n
        if text:
            parts.append(text)
            starts.append(n)
            places.append((first, last, step))
            n += len(text)

    def plain(a: int, b: int) -> None:
        # a piece of the layer that stays: character by character in the original, unless the layer itself is decoded
        if layer.starts is None:
            add(layer.text[a:b], a, b, 1)
        elif a < b:
            edges = [a, *layer.starts[bisect.bisect_right(layer.starts, a) : bisect.bisect_left(layer.starts, b)], b]
            for x, y in pairwise(edges):
                add(layer.text[x:y], *layer.span(x, y), layer.places[bisect.bisect_right(layer.starts, x) - 1][2])

    for m in pattern.finditer(layer.text):
        for said, a, b in decode(m):
            plain(at, a)
            step = (b - a) // len(said)
            if layer.starts is None and not layer.region:
                add(said, a, b, step if step * len(said) == b - a else 0)
            else:
                for j, c in enumerate(said):
                    add(c, *layer.span(a + j * step, a + (j + 1) * step if j + 1 < len(said) else b), 0)
            at = b
    if not parts:
        return None
    plain(at, len(layer.text))
    return Layer("".join(parts), layer.region, starts, places) if not layer.region else Layer("".join(parts), layer.region)


def _percent(m: re.Match) -> Iterator[tuple[str, int, int]]:
    text = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape")  # a byte that is no part of a character is one sign
    at = m.start()
    for width, run in groupby(text, lambda c: 3 if "\udc80" <= c <= "\udcff" else 3 * len(c.encode())):
        said = "".join("\ufffd" if "\udc80" <= c <= "\udcff" else c for c in run)
        yield said, at, at + width * len(said)
        at += width * len(said)


def _escapes(m: re.Match) -> Iterator[tuple[str, int, int]]:
    known = []
    for e in _ESCAPE.finditer(m[0]):
        point = int(e[1] or e[2] or e[3], 16) if not e[4] else int(e[4])
        if point <= 0x10FFFF:
            a, b = m.start() + e.start(), m.start() + e.end()
            if 0xDC00 <= point < 0xE000 and known and known[-1][2] == a and 0xD800 <= known[-1][0] < 0xDC00:
                point, a = 0x10000 + (known.pop()[0] - 0xD800 << 10) + point - 0xDC00, known_at
            known.append((point, a, b))
            known_at = a
    for _, run in groupby(enumerate(known), lambda k: (k[1][2] - k[1][1], k[1][1] - k[0] * (k[1][2] - k[1][1]))):
        run = [k for _, k in run]
        yield "".join("\ufffd" if 0xD800 <= p < 0xE000 else chr(p) for p, _, _ in run), run[0][1], run[-1][2]


def _stream(data: bytes, at: int) -> Iterator[bytes]:
    """What the stream at a place holds, in windows; returns where it ends, or None if it breaks off or there is none."""
    if data[at : at + 2] != b"\x1f\x8b" and (len(data) < at + 3 or (data[at] << 8 | data[at + 1]) % 31):
        return None
    stream, held, size, old, feed = zlib.decompressobj(47), [], 0, 0, b""
    try:
        while not stream.eof and (feed or at < len(data)):
            if not feed:
                feed = data[at : at + _FEED]
                at += len(feed)
            out = stream.decompress(feed, WINDOW - size)
            feed = stream.unconsumed_tail
            held.append(out)
            size += len(out)
            if size == WINDOW:
                window = b"".join(held)
                yield window
                held, size, old = [window[-OVERLAP:]], OVERLAP, OVERLAP
    except zlib.error:
        pass
    if size > old:
        yield b"".join(held)
    return at - len(stream.unused_data) if stream.eof else None


def _contents(blob: Blob, plain: bool = True) -> Iterator[Layer | Blob]:
    """The texts in decoded bytes, and what the streams in them hold; without plain, the latter and wide texts alone."""
    data, first, at, parts = blob.data, 0, 0, []
    while (m := _STREAM.search(data, at)) is not None:
        at = m.start() + 1
        inner = _stream(data, m.start())
        while True:
            try:
                yield Blob(next(inner), blob.region)
            except StopIteration as done:
                if done.value is not None:
                    parts.append(data[first : m.start()])
                    at = first = done.value
                break
    parts.append(data[first:])
    for part in parts:
        if plain and _RUN.search(part):
            yield Layer(part.decode("utf-8", "replace"), blob.region)
        if b"\0" in part:
            for w in _WIDE.finditer(part):
                yield Layer(w[0].replace(b"\0", b"").decode("ascii"), blob.region)


def _unwrapped(run: str) -> Iterator[bytes]:
    """The bytes of a base64 region, read from each of four places."""
    core = run.rstrip("=").replace("-", "+").replace("_", "/")
    for k in range(4):
        part = core[k : len(core) - ((len(core) - k) % 4 == 1)]
        yield base64.b64decode(part + "=" * (-len(part) % 4))


def _unhexed(run: str) -> Iterator[bytes]:
    yield bytes.fromhex(run)


def _regions(text: str, pattern: re.Pattern, last: re.Pattern):
    """(start, end, run) of the runs of a pattern, and of those that go on over lines."""
    lines: list[tuple[int, int, str]] = []

    def joined():
        if lines and not lines[-1][2].endswith("=") and (m := last.match(text, lines[-1][1])):
            lines.append((m.start(1), m.end(1), m[1]))
        if len(lines) > 1:
            yield lines[0][0], lines[-1][1], "".join(run for _, _, run in lines)

    for m in pattern.finditer(text):
        own = m.start(), m.end(), m[0]
        yield own
        if lines and (lines[-1][2].endswith("=") or not _BREAK.fullmatch(text, lines[-1][1], m.start())):
            yield from joined()
            lines = []
        lines.append(own)
    yield from joined()


def _inner(layer: Layer | Blob) -> Iterator[Layer | Blob]:
    """The layers that are one encoding deeper."""
    if isinstance(layer, Blob):
        yield from _contents(layer)
        return
    text = layer.text
    if "%" in text:
        if inner := _with_escapes(layer, _PERCENT, _percent):
            yield inner
        for m in _QUOTED.finditer(text):
            if "%" not in m[0]:
                continue
            yield from _contents(Blob(unquote_to_bytes(m[0]), layer.span(m.start(), m.end())), plain=False)
    if "\\" in text or "&#" in text:
        if inner := _with_escapes(layer, _UNICODE, _escapes):
            yield inner
        for m in _UNICODE.finditer(text):
            said = "".join(piece for piece, _, _ in _escapes(m))
            if any("\x7f" < c for c in said) and all(c <= "\xff" for c in said):
                yield from _contents(Blob(said.encode("latin-1"), layer.span(m.start(), m.end())), plain=False)
    for pattern, last, unwrap in ((_BASE64, _BASE64_END, _unwrapped), (_HEXES, _HEXES_END, _unhexed)):
        for start, end, run in _regions(text, pattern, last):
            for data in unwrap(run):
                yield Blob(data, layer.span(start, end))


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base findings, and all findings: with those in decoded layers, mapped to the text. Layers are made when their turn comes, so a worklist's entry holds one."""
    base = base_findings(text)
    found, seen = set(base), set()
    work = [_inner(Layer(text))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        content = layer.data if isinstance(layer, Blob) else layer.text.encode("utf-8", "surrogatepass")
        mark = (hashlib.blake2b(content, digest_size=16).digest(), type(layer), layer.region, layer.span(0, len(layer.text)) if isinstance(layer, Layer) else None)
        if mark in seen:
            continue
        seen.add(mark)
        if isinstance(layer, Layer):
            found.update((*layer.span(a, b), kind) for a, b, kind in base_findings(layer.text))
        work.append(_inner(layer))
    return base, sorted(found)


SCHEMA = "doc_id long, base array<struct<kind: string, start: long, end: long>>, findings array<struct<kind: string, start: long, end: long>>"
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def secret_scan(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): base and findings, each by start, then kind."""
    common.small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [scan(t) for t in batch.column("text").to_pylist()]
        told = lambda rows: pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in sorted(r, key=lambda x: (x[0], x[2], x[1]))] for r in rows], pa.list_(_FINDING))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), told([d[0] for d in done]), told([d[1] for d in done])], names=["doc_id", "base", "findings"])

    return common.mapped(common.texts(docs), run, SCHEMA)


def secret_digest(docs: DataFrame) -> DataFrame:
    """secret_scan with counts of the base findings and the spans as strings."""
    joined = lambda c: F.array_join(F.transform(c, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda f: f["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return secret_scan(docs).select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("findings").alias("spans"))
