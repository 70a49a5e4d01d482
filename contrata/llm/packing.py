"""Best-two-fit packing of token sequences.

Documents are tokenized whole; longer ones than a sequence are cut into pieces of a full sequence, the first of which
may be shorter. Full pieces are sequences by themselves. For the rest only the number of pieces of each length matters:
this histogram (at most SEQUENCE numbers, whatever the corpus) is packed on the driver. A bin is filled greedily with
the longest piece that fits; then its smallest piece gives way to two unpacked pieces that fit the expanded gap more
tightly, if there are such. A bin's content stays the same until one of its lengths runs out, so bins come in runs.

Pieces then take the places that the plan has for their length, by their rank within it. Ranks are counted in shards of
doc_id and offset by the shards before, so that a length which a third of all pieces have is no single task's work.

Cases: null or empty text: the end token alone. Very long text: cut into as many pieces as it takes. Rows that share a
doc_id: each row is a document; equal rows are told apart by their rank. Null doc_id: packed as well. Extra columns of
documents are left out, those of pieces stay, whatever their names, but for `sequence_id` and `offset`, which give way to
those of the result. Strings of special tokens in a text have those tokens' ids, as the library does by itself, or are
ordinary text if asked for. Empty table: no rows.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrata.llm import common

SEQUENCE = 1024
END = 2
#: Words whose ids a worker remembers; then it forgets them all.
MEMORY = 400_000
#: Rows of a shard in which pieces are ranked, about.
SHARD_ROWS = 200_000

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"

# Texts of these characters only are cut by `re`, as the tokenizer's own pattern cuts them; others by the tokenizer.
_OTHER = re.compile("[^\t\n\r -~¡-±´¶-¸»¿-ɏ‐-‧‰-⁞]")
_CUT = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class _Words(dict):
    """The ids of words, as bytes of little-endian 32-bit numbers."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        ids = self[word] = np.array(self.encode(word.encode()), dtype="<u4").tobytes()
        return ids


class Tokenizer:
    """Ids of whole texts by the vocabulary file, those of special tokens for their strings unless these are ordinary text.

    The file's merges order its vocabulary, so a rank-based encoder built from the same file gives the same ids for a
    word; the words are cut by the byte-level pattern.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        import json

        import tiktoken
        import tokenizers

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, added = file["model"]["vocab"], [t["content"] for t in file["added_tokens"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(shown[c] for c in word): i for word, i in vocabulary.items() if all(c in shown for c in word) and word not in added}
        self.plain = tokenizers.Tokenizer.from_file(path)
        self.plain.encode_special_tokens = special_as_text
        self.special = () if special_as_text else added
        self.words = _Words(tiktoken.Encoding("words", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece)

    def ids(self, text: str) -> bytes:
        if _OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.words.__getitem__, _CUT.findall(text)))


_tokenizers: dict[tuple[str, bool], Tokenizer] = {}


def tokenizer(path: str, special_as_text: bool = False) -> Tokenizer:
    if (path, special_as_text) not in _tokenizers:
        _tokenizers[path, special_as_text] = Tokenizer(path, special_as_text)
    return _tokenizers[path, special_as_text]


def _is_plain(c: str) -> bool:
    """Whether `re` and the tokenizer class the character alike (for tests)."""
    return (unicodedata.category(c)[0] == "L") == bool(re.match(r"[^\W\d_]", c)) and (unicodedata.category(c)[0] == "N") == bool(re.match(r"\d", c))


def token_pieces(docs: DataFrame, vocabulary: str, with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and its ids, if asked for)."""
    common.small_batches(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode, size = tokenizer(vocabulary, special_as_text).ids, 4 * SEQUENCE
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        end = np.array([END], dtype="<u4").tobytes()
        for row, text in enumerate(batch.column("text").to_pylist()):
            data = encode(text) + end
            at, number = 0, 0
            while at < len(data):
                stop = at + size if number or len(data) % size == 0 else len(data) % size
                part = data[at:stop]
                rows.append(row)
                piece.append(number)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<i4"))
                at, number = stop, number + 1
        columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return common.mapped(common.texts(docs), cut, schema)


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, longest first; how many such bins), which hold each piece of the histogram once."""
    left = {length: n for length, n in histogram.items() if n > 0}
    free = 0  # bit l is set while pieces of length l are left
    for length in left:
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} in sequences of {size}")
        free |= 1 << length
    longest = lambda most: (free & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1

    def take(length: int) -> None:
        nonlocal free
        left[length] -= 1
        if not left[length]:
            free &= ~(1 << length)

    def put(length: int) -> None:
        nonlocal free
        left[length] += 1
        free |= 1 << length

    bins = []
    while free:
        now, gap = [], size
        while (x := longest(gap)) > 0:
            now.append(x)
            gap -= x
            take(x)
        if gap and len(now) > 1:
            smallest = now[-1]
            best, pair = smallest, None
            room = gap + smallest
            a = longest(room - 1)
            while a > 0 and 2 * a > best:
                b = longest(min(a, room - a))
                if b == a and left[a] < 2:
                    b = longest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == room:
                        break
                a = longest(a - 1)
            if pair:
                put(now.pop())
                for x in pair:
                    take(x)
                    now.append(x)
        need = {x: now.count(x) for x in now}
        again = min(left[x] // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * again
            if not left[x]:
                free &= ~(1 << x)
        bins.append((tuple(sorted(now, reverse=True)), 1 + again))
    return bins


def _places(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length: the first ranks of its runs, with the number of the run's first bin and the offset in it."""
    out: dict[int, tuple[list[int], list[int], list[int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for lengths, n in bins:
        offset = 0
        for length in lengths:
            starts, numbers, offsets = out.setdefault(length, ([], [], []))
            starts.append(ranks.get(length, 0))
            numbers.append(first)
            offsets.append(offset)
            ranks[length] = ranks.get(length, 0) + n
            offset += length
        first += n
    return out


def place_of(places: dict[int, tuple[list[int], list[int], list[int]]], length: int, rank: int) -> tuple[int, int]:
    starts, numbers, offsets = places[length]
    i = bisect.bisect_right(starts, rank) - 1
    return numbers[i] + rank - starts[i], offsets[i]


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """pieces (with doc_id, piece and length; read more than once) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    places = spark.sparkContext.broadcast(_places(plan(counts, size)))
    shards = max(1, -(-sum(counts.values()) // SHARD_ROWS))
    # a piece's own columns travel in one, where their names meet no others
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    sharded = pieces.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "doc_id", "piece", "length", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int").alias("shard"))
    before = sharded.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = before.select("length", "shard", (F.sum("n").over(Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    ranked = sharded.withColumn("rank", F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, ["length", "shard"]).select("row", "length", (F.col("rank") + F.col("before")).alias("rank"))

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            starts, numbers, offsets = (np.array(x) for x in places.value[int(length)])
            i = np.searchsorted(starts, ranks[own], "right") - 1
            sequence[own] = numbers[i] + ranks[own] - starts[i]
            offset[own] = offsets[i]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"])

    schema = ranked.select("row").schema.add("sequence_id", "long").add("offset", "long")
    return common.mapped(ranked, assign, schema).select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs docs: the columns of token_pieces, with sequence_id and offset."""
    scratch = common.Scratch(docs.sparkSession)
    return pack(scratch.keep(token_pieces(docs, vocabulary, with_ids, special_as_text)))
