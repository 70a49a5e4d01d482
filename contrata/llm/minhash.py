"""Near-duplicate components by banded MinHash with odd sketches.

1. One pass over the texts makes each document's set of distinct word shingles and keeps its size, a 128-bit digest,
   the bucket of each band of its MinHash samples and an odd sketch: the samples folded into a parity bitmap, whose
   XOR with another's counts the samples that differ.
2. Equal sets collapse to one representative, so that a group of copies costs one row.
3. In each bucket every representative is compared with the smallest one only (a star, linear in the bucket). The
   sketches leave out pairs that can't be similar; the rest is confirmed on the full sets, and components follow.
4. Buckets that still hold several components are compared across these by sketch, in blocks of bounded size. Among many
   versions of one text most pairs are just below the threshold, so a second odd sketch, of the whole set, tells these
   apart before any text is fetched: its XOR counts the shingles that differ. Survivors are confirmed in the same way.
   After that each pair that shares a bucket was confirmed, refuted or is connected already, so the components are those
   of all pairs in a bucket; no group is expanded into all its pairs.

Groups may be large. What each member of one has to meet (its digest's representative, its bucket's smallest one with
sketch and text) is looked up by common.looked_up and common.met: keys that more than one in common.MOST_HOT rows have are
dealt to many tasks, with as many copies of what is met there, so a text is sent once for a part of its group.

A pair at the threshold of 0.75 shares a bucket but for five in a million, and passes the sketch but for fewer.

Cases: no words, or a null text: an empty set, linked with nothing. Fewer words than a shingle: all of them are one. Very
long texts: cut whole, in memory that grows with the text. Rows that share a doc_id are one node with several texts: they
get one component, and a row each. A null doc_id: the row stays, with a null component, and is kept. Extra columns,
whatever their names, do no harm. No rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrata.llm import common
from contrata.llm.shingles import WIDTH, mix, shingle_sets

SAMPLES, BANDS, BITS = 128, 32, 512
#: Bits of the odd sketch of a whole set; it saturates, and then leaves nothing out, beyond some thousand differing shingles.
SET_BITS = 2048
THRESHOLD_PERCENT = 75
#: A sketch must show this much at least: the threshold less five standard errors of the samples.
SKETCH_LEAST = 0.55
#: Members compared at a time in a bucket that holds several components.
BLOCK = 1024

_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
_A = (_SEEDS[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (_SEEDS[SAMPLES:] >> np.uint64(32)).astype(np.uint32)
_CHUNK = 1024
_SKETCH_SCHEMA = "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>, sketch array<long>, set_sketch binary"


def samples(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over a set that isn't empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), _CHUNK):
        np.minimum(out, (x[None, i : i + _CHUNK] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return out


def odd_sketches(matrix: np.ndarray) -> np.ndarray:
    """Parity bitmaps of rows of samples, as 64-bit words."""
    n = len(matrix)
    bits = mix((matrix.astype(np.uint64) << np.uint64(8)) ^ mix(np.arange(matrix.shape[1], dtype=np.uint64) + np.uint64(7))[None, :]) % np.uint64(BITS)
    flat = np.bincount((np.arange(n, dtype=np.int64)[:, None] * BITS + bits.astype(np.int64)).ravel(), minlength=n * BITS)
    return np.packbits((flat & 1).astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)


def most_differing() -> int:
    """The XOR population count expected at a similarity of SKETCH_LEAST; more means less similar."""
    differing = 2 * SAMPLES * (1 - SKETCH_LEAST)
    return int(np.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** differing)))


def set_sketches(sets: list[np.ndarray]) -> list[bytes]:
    """Parity bitmaps of whole sets."""
    out = []
    for i in range(0, len(sets), 256):
        part = sets[i : i + 256]
        owner = np.repeat(np.arange(len(part)), [len(s) for s in part])
        flat = np.bincount(owner * SET_BITS + (np.concatenate(part) % np.uint64(SET_BITS)).astype(np.int64), minlength=len(part) * SET_BITS)
        out += [row.tobytes() for row in np.packbits((flat & 1).astype(np.uint8).reshape(-1, SET_BITS), axis=1)]
    return out


def most_differing_sets(sizes: np.ndarray) -> np.ndarray:
    """The XOR population count, by the sum of two sets' sizes, that a pair at the threshold exceeds in less than one of 10^8 cases: six standard deviations above the mean."""
    t = THRESHOLD_PERCENT / 100
    m = np.floor(np.asarray(sizes, dtype=np.float64) * (1 - t) / (1 + t))
    one, two = (1 - 2 / SET_BITS) ** m, (1 - 4 / SET_BITS) ** m
    variance = SET_BITS / 4 * (1 - one**2) + SET_BITS * (SET_BITS - 1) / 4 * (two - one**2)
    return np.ceil(SET_BITS / 2 * (1 - one) + 6 * np.sqrt(np.maximum(variance, 0)) + 2)


def _bands(matrix: np.ndarray) -> np.ndarray:
    rows = SAMPLES // BANDS
    out = np.zeros((len(matrix), BANDS), dtype=np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(40))
    for r in range(rows):
        out = mix(out ^ matrix[:, r::rows].astype(np.uint64))
    return out.view(np.int64)


def _lists(values: np.ndarray, present: np.ndarray, width: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(~present))


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    present = sizes > 0
    matrix = np.array([samples(s) for s in sets if len(s)], dtype=np.uint32).reshape(-1, SAMPLES)
    digest = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _lists(_bands(matrix), present, BANDS), _lists(odd_sketches(matrix), present, BITS // 64), pa.array(set_sketches(sets), pa.binary())],
        names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "sketch", "set_sketch"],
    )


def _differing(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, BITS // 64)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _similar(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The pairs of a batch whose full sets are similar enough; a text that comes again and again is cut once."""
    names = {"a": "text_a", "b": "text_b"}
    codes, sets = {}, {}
    for k, name in names.items():
        encoded = batch.column(name).dictionary_encode()
        codes[k], sets[k] = encoded.indices.to_numpy(zero_copy_only=False), shingle_sets(encoded.dictionary)
    keep = np.zeros(batch.num_rows, dtype=bool)
    for i in range(batch.num_rows):
        x, y = sets["a"][codes["a"][i]], sets["b"][codes["b"][i]]
        small, large = (x, y) if len(x) <= len(y) else (y, x)
        if len(small) and 100 * len(small) >= THRESHOLD_PERCENT * len(large):
            at = np.searchsorted(large, small)
            common_ = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            keep[i] = 100 * common_ >= THRESHOLD_PERCENT * (len(small) + len(large) - common_)
    return batch.select(["a", "b"]).filter(pa.array(keep))


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """pairs (a, b) of ids whose documents' full sets are similar; each side's text comes by one join on its id. pairs: a written table."""
    for k, other in ("ab", "ba"):
        texts = docs.select(F.col("doc_id").alias(k), F.col("text").alias(f"text_{k}"))
        both = common.met(pairs if k == "a" else both, texts, [k], common.hot_keys_of(pairs, [k]), [other])
    return common.mapped(both.select("a", "b", "text_a", "text_b"), _similar, "a long, b long")


def components(edges: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(node, label) of each node in edges (a, b); label: the smallest node of its component.

    Large-star and small-star steps in turn until every node points at its component's smallest node. Each step is
    joins and aggregations on edges alone, which never become more, and is written down before the next.
    """
    now = scratch.keep(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        count = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not count[0] or seen == tuple(count):
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct() if count[0] else now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = tuple(count)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = common.looked_up(both.where("v > u"), least, ["u"], "m", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large.where("u != v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = common.looked_up(large, least, ["u"], "m", "n").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = scratch.keep(small.where("u != v").distinct())
        scratch.drop(now, large)
        now = after


def _across(bits_most: int):
    """For a group's members, the pairs with different labels whose sketches are close; a cell of two blocks compares these with each other only."""

    def run(group: pa.Table) -> pa.Table:
        node, label = group.column("node").to_numpy(), group.column("label").to_numpy()
        side = group.column("side").to_numpy()
        words = np.array(group.column("sketch").to_pylist(), dtype=np.int64).view(np.uint64)
        sizes = group.column("n_shingles").to_numpy()
        whole = np.frombuffer(b"".join(group.column("set_sketch").to_pylist()), dtype=np.uint64).reshape(-1, SET_BITS // 64)
        bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
        bucket = group.column("bucket")[0].as_py()
        left = np.flatnonzero(side != 2)
        right = np.flatnonzero(side != 1)
        found_a, found_b = [], []
        for i in left:
            others = right[(label[right] != label[i]) & ((side[i] == 1) | (node[right] > node[i]))]
            close = others[np.bitwise_count(words[others] ^ words[i]).sum(axis=1) <= bits_most]
            close = close[np.bitwise_count(whole[close] ^ whole[i]).sum(axis=1) <= most_differing_sets(sizes[close] + sizes[i])]
            # a pair meets in each bucket that it shares, and is told in the first of them alone
            shared = bands[close] == bands[i]
            close = close[bands[i][shared.argmax(axis=1)] == bucket]
            found_a += [node[i]] * len(close)
            found_b += node[close].tolist()
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return run


def _cross_pairs(members: DataFrame, labels: DataFrame, sketches: DataFrame, scratch: common.Scratch) -> DataFrame:
    """Pairs (a, b) in buckets that hold several labels, of different labels and with close sketches."""
    labelled = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", F.col("rep").alias("node"), F.coalesce("label", "rep").alias("label"))
    labelled = scratch.keep(labelled)
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("bucket", "n")
    open_ = common.looked_up(labelled, mixed.withColumn("size", F.col("n")), ["bucket"], "size", "n")
    open_ = open_.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # cell (i, j), i <= j, holds blocks i and j; within i = j all members meet, else one side meets the other
    cells = open_.select("bucket", "node", "label", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("bucket", "node", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"))
    with_sketch = cells.join(sketches.select(F.col("doc_id").alias("node"), "n_shingles", "bands", "sketch", "set_sketch"), "node")
    return with_sketch.groupBy("bucket", "i", "j").applyInArrow(_across(most_differing()), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    docs, scratch = common.texts(docs), common.Scratch(spark)
    sketched = scratch.keep(common.mapped(docs, _sketch, _SKETCH_SCHEMA))
    named = sketched.where("doc_id is not null and n_shingles > 0")
    of_digest = named.groupBy("digest_a", "digest_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    copies = common.looked_up(named.select("doc_id", "digest_a", "digest_b"), of_digest, ["digest_a", "digest_b"], "rep", "n")
    copies = scratch.keep(copies.select("doc_id", "rep").distinct())
    sketches = named.select("doc_id", "bands").join(copies.where("doc_id = rep").select("doc_id").distinct(), "doc_id")
    members = sketches.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket")).distinct()
    shared = scratch.keep(members.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).where("n > 1"))
    members = scratch.keep(common.looked_up(members, shared, ["bucket"], "centre", "n"))

    star = scratch.keep(members.where("rep != centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct())
    sides = [named.select(F.col("doc_id").alias(k), F.col("sketch").alias(f"sketch_{k}")) for k in "ab"]
    close = common.met(star.join(sides[0], "a"), sides[1], ["b"], common.hot_keys_of(star, ["b"]), ["a"]).where(_differing("sketch_a", "sketch_b") <= most_differing())
    close = scratch.keep(close.select("a", "b").distinct())
    links = scratch.keep(_confirmed(close, docs))
    labels = scratch.keep(components(links, scratch))

    crossing = scratch.keep(_cross_pairs(members.select("bucket", "rep"), labels, named.select("doc_id", "n_shingles", "bands", "sketch", "set_sketch"), scratch))
    more = scratch.keep(_confirmed(crossing, docs))
    # a doc_id with several texts links the representatives of all of them
    several = copies.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b < most")
    same = copies.join(several, "doc_id").select(F.col("rep").alias("a"), "b")
    groups = scratch.keep(components(links.unionByName(more).unionByName(same), scratch))
    scratch.drop(shared, members, star, close, links, labels, crossing, more)
    of_doc = common.looked_up(copies.withColumnRenamed("rep", "node"), groups, ["node"], "label", how="left").select("doc_id", F.coalesce("label", "node").alias("label"))
    of_doc = of_doc.groupBy("doc_id").agg(F.min("label").alias("label"))
    out = sketched.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs whose document stays: of each component, the one with the smallest doc_id."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")


__all__ = ["WIDTH", "components", "keep_one", "near_duplicates", "Iterator"]
