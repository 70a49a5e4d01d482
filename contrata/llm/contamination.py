"""Benchmark decontamination: size-partitioned MinHash containment search.

Short items are sought inside documents of any length, where the Jaccard similarity is near zero and banding finds
nothing; containment doesn't suffer. Items of fewer words than a shingle are one shingle of all their words, and are
sought among the documents' shingles of that many words, each such length being partitions of its own. Items are
partitioned by the size of their shingle set. Each partition keeps the
MinHash samples of its items (the shingles that are smallest under SAMPLES hash functions; all of them for items with
fewer). A document is searched only against partitions whose items it is large enough to contain; each of its shingles
is looked up among the samples, so an item with a containment of 0.75 shows no sample in 1 of 4^16 cases. Each
candidate is then verified on the full sets: matched, if 100 * |item & document| >= 75 * |item|.

The documents are read once and never shuffled. The benchmark, the stated query set, is broadcast in blocks of at most
BLOCK_SHINGLES shingles; a larger one takes more passes.

Cases: an item or document without words, or null, matches nothing. An item of one word is in each document that has the
word. Very long documents are searched whole, in pieces of bounded memory but for one longer than that. Rows with equal
ids are rows of their own. Null ids are carried along. Extra columns, whatever their names, do no harm. Empty tables: no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrata.llm import common
from contrata.llm.shingles import WIDTH, mix, shingle_sets, shingles, utf8, word_hashes

SAMPLES = 16
THRESHOLD_PERCENT = 75
#: Shingles of the items that are broadcast at a time (8 bytes each).
BLOCK_SHINGLES = 4 << 20
_FILTER_BITS = 22
_SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) + np.uint64(0xC0))

PAIRS = "doc_id long, item_id long, n_item long, n_common long"


def minhash_samples(items: np.ndarray) -> np.ndarray:
    """The distinct shingles of a set that are the smallest under one of the hash functions."""
    if len(items) <= SAMPLES:
        return items
    return np.unique(items[[int(np.argmin(mix(items ^ seed))) for seed in _SEEDS]])


class Partition:
    """Items whose sets have between `least` and twice as many shingles: their samples, sorted, and who has them."""

    def __init__(self, numbers: list[int], sets: list[np.ndarray]):
        self.least = min(len(s) for s in sets)
        pairs = sorted((int(v), n) for n, s in zip(numbers, sets, strict=True) for v in minhash_samples(s))
        self.values = np.array([v for v, _ in pairs], dtype=np.uint64)
        self.items = np.array([n for _, n in pairs], dtype=np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.values >> np.uint64(64 - _FILTER_BITS)] = True

    def candidates(self, shingle: np.ndarray, document: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) of the shingles that are samples."""
        maybe = np.flatnonzero(self.filter[shingle >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.values, shingle[maybe], "left")
        high = np.searchsorted(self.values, shingle[maybe], "right")
        hit = np.flatnonzero(high > low)
        n = high[hit] - low[hit]
        place = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(hit) else hit
        pairs = np.unique(np.stack([np.repeat(document[maybe[hit]], n), self.items[place]], axis=1), axis=0)
        return {(int(d), int(i)) for d, i in pairs}


def item_set(text: str) -> tuple[int, np.ndarray]:
    """How many words the item's shingles have, and the shingles."""
    column = pa.array([text])
    words = int(word_hashes(*utf8(column))[1][-1])
    width = min(WIDTH, max(words, 1))
    return width, shingle_sets(column, width)[0]


class Index:
    def __init__(self, ids: list[int | None], widths: list[int], sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        by_size: dict[tuple[int, int], list[int]] = {}
        for n, s in enumerate(sets):
            if len(s):
                by_size.setdefault((widths[n], len(s).bit_length()), []).append(n)
        self.partitions: dict[int, list[Partition]] = {}
        for (width, _), numbers in sorted(by_size.items()):
            self.partitions.setdefault(width, []).append(Partition(numbers, [sets[n] for n in numbers]))

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item number, common shingles) of the items that the column's texts contain."""
        for width, partitions in self.partitions.items():
            for start, values, place in shingles(column, width):
                sizes = np.diff(place)
                document = np.repeat(np.arange(len(sizes)), sizes)
                found: set[tuple[int, int]] = set()
                for partition in partitions:
                    enough = 100 * sizes >= THRESHOLD_PERCENT * partition.least
                    if enough.any():
                        inside = slice(None) if enough.all() else np.repeat(enough, sizes)
                        found |= partition.candidates(values[inside], document[inside])
                at, own = -1, None
                for row, item in sorted(found):
                    if row != at:
                        at, own = row, np.unique(values[place[row] : place[row + 1]])
                    wanted = self.sets[item]
                    common_ = int((own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)] == wanted).sum())
                    if 100 * common_ >= THRESHOLD_PERCENT * len(wanted):
                        yield start + row, item, common_


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of all items, each over a block that is bounded in shingles (one longer item is a block)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids, widths, sets, size = [], [], [], 0
    for row in items.toLocalIterator():
        width, s = item_set(row.text)
        if ids and size + len(s) > BLOCK_SHINGLES:
            yield Index(ids, widths, sets)
            ids, widths, sets, size = [], [], [], 0
        ids.append(row.item_id)
        widths.append(width)
        sets.append(s)
        size += len(s)
    if ids:
        yield Index(ids, widths, sets)


def contained_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_common for each document and each item that it contains."""
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = common.texts(docs)
    out = spark.createDataFrame([], PAIRS)
    for n, index in enumerate(_blocks(benchmark)):
        shared = spark.sparkContext.broadcast(index)

        def match(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            index = shared.value
            found = list(index.matches(batch.column("text")))
            rows = pa.array([f[0] for f in found], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), pa.array([index.ids[f[1]] for f in found], pa.int64()), pa.array([len(index.sets[f[1]]) for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                names=["doc_id", "item_id", "n_item", "n_common"],
            )

        part = common.mapped(docs, match, PAIRS)
        out = part if not n else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that contain no item of the benchmark. Nothing is shuffled."""
    spark = docs.sparkSession
    common.small_batches(spark)
    for index in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def clean(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[row for row, _, _ in shared.value.matches(batch.column("text"))]] = False
            return batch.filter(pa.array(keep))

        docs = common.mapped(docs, clean, docs.schema)
    return docs
