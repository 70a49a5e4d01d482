"""Chat formatting by schema fingerprints.

Records are JSON objects of any layout. A record's fingerprint is the hash of its sorted nested field paths (array
elements as []). It selects a declarative mapping, which says where the turns are; no code is written per layout. Fields
that no mapping speaks of (ids, weights, scores) tell nothing about the layout: a record whose own fingerprint no mapping
has is looked up by that of the paths that some mapping declares. One that isn't found by that either gets no turns and
is reported by its fingerprint, so that a mapping can be added.

Canonical turns are rendered by a template that marks each turn with control strings. Inside texts and roles every `<`,
followed by any number of backslashes and `|`, gets one backslash more, so that no control string can be forged; reading
takes it away again. The mask of the loss is the spans of the assistants' texts in the rendered string.

Cases: null or empty text: an empty turn. Null role: an empty one. Turns are in the order of their number, then role,
then text, nulls first; repeated rows are repeated turns. A null conv_id is a conversation of its own. An empty list of
turns: no turns, in the layout that the list belongs to. An element that isn't an object: no mapping. Very long texts: as
any other. Extra columns, whatever their names: left out. Empty table: only what the query adds. Invalid JSON, and JSON
nested deeper than its parser goes: no turns, fingerprint `invalid`.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrata.llm import common

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns. paths: the fields of the layout. turns: the list of turns, with the fields of role and text; or pairs of a fixed role and the path of its text, in order, of which absent or empty ones are passed over if they are optional."""

    name: str
    paths: tuple[str, ...]
    list_at: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


_SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("prompter", "user"))
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("messages", ("messages[].role", "messages[].content"), "messages", "role", "content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), "conversations", "from", "value", roles=_SPEAKERS),
    Mapping("nested_turns", ("dialog.turns[].speaker", "dialog.turns[].utterance"), "dialog.turns", "speaker", "utterance", roles=_SPEAKERS),
    Mapping("prompt_response", ("prompt", "response"), fixed=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", ("prompt", "completion"), fixed=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", ("instruction", "output"), fixed=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Mapping("question_answer", ("question", "answer"), fixed=(("system", "context"), ("user", "question"), ("assistant", "answer")), optional=("context",)),
)


def field_paths(value) -> set[str]:
    """The paths of all leaves; an empty list or object is a leaf that says so. Nesting costs no stack."""
    out, work = set(), [("", value)]
    while work:
        at, value = work.pop()
        if isinstance(value, dict):
            work += [(f"{at}.{k}" if at else k, v) for k, v in value.items()]
            if not value:
                out.add(f"{at}{{}}")
        elif isinstance(value, list):
            work += [(f"{at}[]", v) for v in value]
            if not value:
                out.add(f"{at}[] none")
        else:
            out.add(at)
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Mappings by the fingerprints of their layouts: one for each choice of optional fields, and for an empty list of turns."""
    out = {}
    for m in mappings:
        for chosen in range(1 << len(m.optional)):
            paths = [*m.paths, *(o for k, o in enumerate(m.optional) if chosen >> k & 1)]
            out.setdefault(fingerprint(paths), m)
        if m.list_at:
            out.setdefault(fingerprint([f"{m.list_at}[] none"]), m)
    return out


def declared(mappings=MAPPINGS) -> set[str]:
    """The paths that tell of a layout: those of the mappings, and whatever stands where a list of turns, an element or a field of it should."""
    out = set()
    for m in mappings:
        out |= {*m.paths, *m.optional}
        if m.list_at:
            out |= {m.list_at, f"{m.list_at}{{}}", f"{m.list_at}[]", f"{m.list_at}[] none", f"{m.list_at}[]{{}}", f"{m.list_at}[][] none"}
    return out


def mapping_of(paths: set[str], known: dict[str, Mapping], of_layout: set[str]) -> Mapping | None:
    found = known.get(fingerprint(paths)) or known.get(fingerprint(paths & of_layout))
    return found if found and not any(p.startswith(f"{found.list_at}[][]") for p in paths) else None


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def canonical_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    text = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    if mapping.list_at:
        names = dict(mapping.roles)
        turns = [(text(t.get(mapping.role)), text(t.get(mapping.text))) for t in _at(record, mapping.list_at)]
        return [(names.get(role, role), said) for role, said in turns]
    out = []
    for role, path in mapping.fixed:
        said = _at(record, path)
        if path not in mapping.optional or said:
            out.append((role, text(said)))
    return out


_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and the spans of it, in code points, that the loss covers."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string. A role's newlines can't be told from the one that ends it, so roles have none (canonical_turns of this module's mappings keep those of the record; render is exact for roles of one line)."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape(role), unescape(rest.removesuffix(CLOSE))))
    return turns


SCHEMA = "conv_id long, fingerprint string, layout string, formatted string, loss_spans array<struct<start: long, end: long>>"


def format_records(records: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """Per row of records (conv_id, record: JSON): its fingerprint, the layout's name (null: no mapping), the formatted string and the spans of the loss."""
    common.small_batches(records.sparkSession)
    known, of_layout = registry(mappings), declared(mappings)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints, layouts, formatted, spans = [], [], [], []
        for text in batch.column("record").to_pylist():
            try:
                record = json.loads(text)
                paths = field_paths(record)
                mark, mapping = fingerprint(paths), mapping_of(paths, known, of_layout)
            except (TypeError, ValueError, RecursionError):
                record, mark, mapping = None, "invalid", None
            out, own = render(canonical_turns(record, mapping)) if mapping else (None, [])
            prints.append(mark)
            layouts.append(mapping.name if mapping else None)
            formatted.append(out)
            spans.append([{"start": a, "end": b} for a, b in own])
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(prints, pa.string()), pa.array(layouts, pa.string()), pa.array(formatted, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "fingerprint", "layout", "formatted", "loss_spans"])

    return common.mapped(records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("record").cast("string").alias("record")), run, SCHEMA)


def records_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): the rows of each conversation as a record. Layouts differ: a user's turn and the assistant's is a prompt with its response, others are lists of messages, those with odd ids under the names of another layout."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    pair = (F.size("t") == 2) & (F.get("t", F.lit(0))["role"] == "user") & (F.get("t", F.lit(1))["role"] == "assistant")
    plain = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    # a role that the mapping would rename stays in the layout that renames none
    renamed = F.exists("t", lambda x: x["role"].isin([a for a, _ in _SPEAKERS]))
    other = F.to_json(F.struct(F.transform("t", lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")))
    single = F.to_json(F.struct(F.get("t", F.lit(0))["text"].alias("prompt"), F.get("t", F.lit(1))["text"].alias("response")))
    odd = F.coalesce(F.pmod("conv_id", F.lit(2)) == 1, F.lit(False))
    return turns.select("conv_id", F.when(pair, single).when(odd & ~renamed, other).otherwise(plain).alias("record"))


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted strings and their spans."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, turns_sha, loss, loss_sha, chars = [], [], [], [], []
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
            turns = read_back(text or "")
            under = "".join(unescape((text or "")[s["start"] : s["end"]]) for s in spans)
            n.append(len(turns))
            turns_sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest())
            loss.append(len(under))
            loss_sha.append(hashlib.sha256(under.encode("utf-8", "surrogatepass")).hexdigest())
            chars.append(len(text or ""))
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(loss, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(chars, pa.int64())], names=DIGEST.replace(" long", "").replace(" string", "").split(", "))

    return common.mapped(formatted.select("conv_id", "formatted", "loss_spans"), run, DIGEST)
