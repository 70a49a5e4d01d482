"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

The model predicts characters from the ORDER - 1 before them. One pass over all documents counts their grams, and apart
from that those of trusted text (all trusted documents but one in HELD_OUT): each task adds up the counts of its own texts
before they are shuffled. The counts of lower orders, their contexts' totals, discounts and interpolation weights follow
by aggregations and joins of count tables, which Spark deals out by gram or context.

Scoring is a join of counts: every gram of the corpus gets its log probability once, by joins of the count tables from
the highest order down, and a document's log probability is the sum over its grams. Grams are unevenly common, so the
HOT_GRAMS most common ones, a broadcast of fixed size, are added up where the document is read; a document's other grams
and their numbers are joined with the probabilities by gram. None of those is common enough to make a task larger than
others. The plan is the same at all sizes, and the model never comes together in one place.

A document is trusted if its id is labelled so. Texts don't move to be told: a Bloom filter of fixed size goes to them,
and the counts of the documents that it lets through wrongly, which a join of ids finds, are taken off again.

A document is rejected if its perplexity lies outside the quantiles LOW and HIGH of trusted documents of its language,
widened by the factor SLACK. Short texts vary more, so quantiles are taken among documents whose lengths have the same
number of bits. A language with fewer than LEAST_TRUSTED held-out documents is still judged by its own, with a slack that
is wider the fewer there are; if none of its trusted documents is held out, its upper limit is at least that of all
languages. Both tails go: symbols, capitals and tables are unlikely, text that repeats itself is either.

Cases: null or empty text: no perplexity, rejected. Very long text: taken in parts of bounded size. Null language: the
quantiles of trusted documents without one, if there are such; else, and for a language that no trusted document has,
those of all languages. A document that is labelled twice is trusted if one label says so; labels for absent documents do
nothing. No trusted text: all with text are kept. Repeated rows and null doc_ids: a row each. Extra columns, whatever
their names, do no harm. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.llm import common
from contrata.llm.shingles import mix

ORDER = 5
#: The corpus's most common grams, whose probabilities are broadcast (about 32 bytes each in the lookup table).
HOT_GRAMS = 1 << 18
#: Counts that a task holds before it adds up those of equal grams (24 bytes each); of more than half as many grams it passes the counts on.
HELD_GRAMS = 1 << 19
LOW, HIGH, SLACK = 0.01, 0.99, 1.1
#: A quantile of a length is taken over so many held-out documents at least, else it is that of all lengths; a language with fewer has a wider slack.
LEAST_TRUSTED = 50
#: One in so many trusted documents is held out of the counts: a model knows its own texts better than others of the same
#: kind, so the upper quantile is that of trusted texts it hasn't seen (the lower one is that of all).
HELD_OUT = 4
#: Bits of the filter of trusted ids, and bits of each id in it.
FILTER_BITS, FILTER_HASHES = 1 << 27, 5
START = 2

_FACTORS = mix(np.arange(11, 11 + ORDER, dtype=np.uint64)) | np.uint64(1)
#: Bits of a sign in the key of a gram that has no sign beyond them.
_BITS = 60 // ORDER
_NARROW, _WIDE = 1 << _BITS, np.uint64(1 << 63)
_PIECE = 1 << 18
_FILTER = mix(np.arange(1, FILTER_HASHES + 1, dtype=np.uint64) << np.uint64(32))


class Lookup:
    """Values by 64-bit key, in an open-addressed table of arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * max(len(keys), 1) - 1).bit_length())
        self.mask = np.uint64(size - 1)
        keys = keys + np.uint64(1)  # 0 is a free place
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size)
        left, at = np.arange(len(keys)), mix(keys) & self.mask
        while len(left):
            free = self.keys[at] == 0
            place, own = at[free], left[free]
            self.keys[place] = keys[own]  # of several for one place, one gets it
            got = self.keys[at] == keys[left]
            self.values[at[got]] = values[left[got]]
            left, at = left[~got], (at[~got] + np.uint64(1)) & self.mask

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where there is none, and whether there is one."""
        keys = keys + np.uint64(1)
        at = mix(keys) & self.mask
        there = self.keys[at]
        found = there == keys
        out = np.where(found, self.values[at], 0.0)
        open_ = np.flatnonzero(~found & (there != 0))
        at = at[open_]
        while len(open_):
            at = (at + np.uint64(1)) & self.mask
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            found[open_[hit]] = True
            on = ~hit & (there != 0)
            open_, at = open_[on], at[on]
        return out, found


def symbols(text: str) -> np.ndarray:
    """Code points. Digits are one sign, and so are white spaces."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    points[(points >= 48) & (points <= 57)] = 48
    points[(points >= 9) & (points <= 13)] = 32
    return points


def gram_keys(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of the grams of the highest order that end at the places: their signs, if all are below _NARROW, else a hash with the highest bit."""
    packed = points[ORDER - 1 :].copy()
    for j in range(1, ORDER):
        packed |= points[ORDER - 1 - j : len(points) - j] << np.uint64(_BITS * j)
    keys = packed[ends - (ORDER - 1)]
    if len(points) and points.max() >= _NARROW:
        wide = np.concatenate([[0], np.cumsum(points >= _NARROW)])
        at = np.flatnonzero(wide[ends + 1] > wide[ends - (ORDER - 1)])
        total = np.zeros(len(at), dtype=np.uint64)
        for j in range(ORDER):
            total += (points[ends[at] - j] + np.uint64(1)) * _FACTORS[j]
        keys[at] = mix(total) | _WIDE
    return keys


def places(texts: list[str], piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Signs, the places in them that are predicted, and whose text each place is in; some `piece` signs at a time. A text begins after ORDER - 1 start signs, a longer one's parts after the signs before them."""
    parts, owners, size = [], [], 0

    def told():
        points = symbols("".join(parts))
        lengths = np.array([len(p) for p in parts])
        first = np.cumsum(lengths) - lengths
        told = points != START
        told[np.minimum(first[:, None] + np.arange(ORDER - 1)[None, :], len(points) - 1).ravel()] = False
        ends = np.flatnonzero(told)
        return points, ends, np.repeat(np.array(owners), lengths)[ends]

    for owner, text in enumerate(texts):
        for at in range(0, len(text), piece):
            parts.append(text[at - ORDER + 1 : at + piece] if at else chr(START) * (ORDER - 1) + text[:piece])
            owners.append(owner)
            size += len(parts[-1])
            if size >= piece:
                yield told()
                parts, owners, size = [], [], 0
    if parts:
        yield told()


def _grams(points: np.ndarray, ends: np.ndarray) -> list[str]:
    text = points[ends[:, None] + np.arange(1 - ORDER, 1)[None, :]].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    return [text[k : k + ORDER] for k in range(0, len(text), ORDER)]


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


class _Counts:
    """Keys of grams with their numbers in all texts and in trusted ones, and the signs of those whose keys don't tell them."""

    def __init__(self):
        self.parts, self.wide, self.size = [], {}, 0

    def add(self, points: np.ndarray, ends: np.ndarray, trusted: np.ndarray) -> None:
        keys = gram_keys(points, ends)
        wide = np.flatnonzero(keys >= _WIDE)
        if len(wide):
            new, first = np.unique(keys[wide], return_index=True)
            self.wide.update(zip(new.tolist(), _grams(points, ends[wide[first]]), strict=True))
        for own, t in ((keys[~trusted], 0), (keys[trusted], 1)):
            own = np.sort(own)
            first = _runs(own)
            c = np.diff(np.append(first, len(own)))
            self.parts.append((own[first], c, c * t))
            self.size += len(first)

    def merge(self) -> None:
        keys, c, t = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        first = _runs(keys)
        self.parts = [(keys[first], np.add.reduceat(c[order], first), np.add.reduceat(t[order], first))] if len(keys) else []
        self.size = len(first)

    def told(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
        for keys, c, t in self.parts:
            for i in range(0, len(c), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(self.grams(keys[part])), pa.array(c[part]), pa.array(t[part])], names=["gram", "c", "t"])
        self.__init__()

    def grams(self, keys: np.ndarray) -> list[str]:
        shift = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(_BITS)
        text = (np.where(keys < _WIDE, keys, 0)[:, None] >> shift[None, :] & np.uint64(_NARROW - 1)).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        out = [text[k : k + ORDER] for k in range(0, len(text), ORDER)]
        for i in np.flatnonzero(keys >= _WIDE):
            out[i] = self.wide[int(keys[i])]
        return out


class Filter:
    """A Bloom filter of ids."""

    def __init__(self, bits: int):
        self.words = np.zeros(bits // 64, np.uint64)

    def bits_of(self, ids: np.ndarray) -> np.ndarray:
        """(ids, FILTER_HASHES): the bits of each id."""
        return (mix(mix(ids.view(np.uint64))[:, None] + _FILTER[None, :]) % np.uint64(64 * len(self.words))).astype(np.int64)

    def may_have(self, ids: pa.Array) -> np.ndarray:
        bits = self.bits_of(ids.fill_null(0).to_numpy(zero_copy_only=False))
        found = (self.words[bits >> 6] >> (bits & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)
        return found & ids.is_valid().to_numpy(zero_copy_only=False)


def filter_of(ids: DataFrame) -> Filter:
    """The filter of a column doc_id: tasks set their ids' bits, words of equal place are joined, and at most FILTER_BITS come to the driver."""
    out = Filter(FILTER_BITS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = np.unique(Filter(FILTER_BITS).bits_of(batch.column("doc_id").to_numpy()).ravel())
        words, first = np.unique(bits >> 6, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (bits & 63).astype(np.uint64), first).view(np.int64))], names=["word", "bits"])

    told = common.mapped(ids.where("doc_id is not null"), run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # of fixed size
    out.words[told["word"].to_numpy()] = told["bits"].to_numpy().view(np.uint64)
    return out


def counted(rows: DataFrame, trusted_ids: Broadcast | None = None) -> DataFrame:
    """(gram, c, t): the grams of the highest order, with their numbers in all texts and in those that aren't held out and whose id the filter may have (without one: in all). rows: doc_id, text, held."""

    def run(batches):
        counts = _Counts()
        for batch in batches:
            trusted = ~np.array(batch.column("held").to_pylist(), dtype=bool)
            if trusted_ids:
                trusted &= trusted_ids.value.may_have(batch.column("doc_id"))
            for points, ends, owner in places(batch.column("text").to_pylist(), _PIECE):
                counts.add(points, ends, trusted[owner])
                if counts.size > HELD_GRAMS:
                    counts.merge()
                if counts.size > HELD_GRAMS // 2:
                    yield from counts.told()
        yield from counts.told()

    return rows.select("doc_id", "text", "held").mapInArrow(run, "gram string, c long, t long").groupBy("gram").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def passed(rows: DataFrame, ids: Broadcast) -> DataFrame:
    """The rows (with doc_id) whose id a filter may have; nothing is shuffled."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(ids.value.may_have(batch.column("doc_id"))))

    return common.mapped(rows, run, rows.schema)


def gram_counts(rows: DataFrame, good: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(gram, c, t) of all rows and of the trusted ones: those whose id is in good and that aren't held out."""
    send = rows.sparkSession.sparkContext.broadcast
    ids = send(filter_of(good))
    rows = rows.withColumn("held", F.coalesce(held_out(), F.lit(True)))
    counts = scratch.keep(counted(rows, ids))
    wrong = passed(rows.where("not held").select("doc_id").distinct(), ids).join(good, "doc_id", "left_anti")
    wrong = scratch.keep(wrong)
    if wrong.first():
        texts = passed(rows.where("not held"), send(filter_of(wrong))).join(wrong, "doc_id", "left_semi")
        off = counted(texts).select("gram", F.lit(0).cast("long").alias("c"), (-F.col("t")).alias("t"))
        counts = scratch.keep(counts.unionByName(off).groupBy("gram").agg(F.sum("c").alias("c"), F.sum("t").alias("t")))
    ids.unpersist()
    return counts


def held_out() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0


def train(counts: DataFrame, scratch: common.Scratch) -> tuple[dict[int, DataFrame], dict[int, DataFrame], float]:
    """counts: (gram, c) of the highest order. By order: (gram, p), the probabilities of seen grams, and (context, weight); and the log probability of a sign that was never seen."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = scratch.keep(tables[n + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("c")))
    seen, weights, unseen = {}, {}, math.log(1e-6)
    for n in range(1, ORDER + 1):
        table = tables[n]
        of = table.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)], F.count("*").alias("types")).first()
        y = of.n1 / (of.n1 + 2 * of.n2) if of.n1 else 0.0
        d = [min(max(k - (k + 1) * y * of[f"n{k + 1}"] / of[f"n{k}"], 0.1), k - 0.05) if of[f"n{k}"] else 0.5 for k in (1, 2, 3)]
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = F.substring("gram", 1, n - 1) if n > 1 else F.lit("")
        by_context = table.groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum(discount).alias("held"))
        weights[n] = scratch.keep(by_context.select("context", "total", (F.col("held") / F.col("total")).alias("weight")))
        own = table.select("gram", "c", context.alias("context"), F.expr("substring(gram, 2)").alias("shorter")).join(weights[n], "context")
        mass = (F.col("c") - discount) / F.col("total")
        if n == 1:
            weight = (weights[n].first() or {"weight": 1.0})["weight"]
            unseen = math.log(weight / (of.types + 1)) if of.types else unseen
            probable = own.select("gram", (mass + F.col("weight") / (of.types + 1)).alias("p"))
        else:
            probable = own.join(seen[n - 1].select(F.col("gram").alias("shorter"), F.col("p").alias("q")), "shorter").select("gram", (mass + F.col("weight") * F.col("q")).alias("p"))
        seen[n] = scratch.keep(probable)
    return seen, weights, unseen


def gram_values(counts: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(gram, c, value): the log probability of the last sign of each gram of the corpus, given those before. counts: (gram, c, t)."""
    seen, weights, unseen = train(counts.where("t > 0").select("gram", F.col("t").alias("c")), scratch)
    known = counts.where("t > 0").join(seen[ORDER], "gram").select("gram", "c", F.log("p").alias("value"))
    # what wasn't seen goes down order by order, and takes along the weights of its contexts
    open_ = counts.where("t <= 0").select("gram", "c", F.lit(0.0).alias("w"), F.lit(None).cast("double").alias("value"))
    for n in range(ORDER, 0, -1):
        suffix = F.expr(f"substring(gram, {ORDER - n + 1})")
        if n < ORDER:
            open_ = open_.join(seen[n].select(F.col("gram").alias("g"), "p"), suffix == F.col("g"), "left")
            open_ = open_.select("gram", "c", "w", F.coalesce("value", F.col("w") + F.log("p")).alias("value"))
        if n > 1:
            open_ = open_.join(weights[n].select("context", "weight"), F.substring(suffix, 1, n - 1) == F.col("context"), "left")
            open_ = open_.select("gram", "c", (F.col("w") + F.coalesce(F.log("weight"), F.lit(0.0))).alias("w"), "value")
    told = open_.select("gram", "c", F.coalesce("value", F.col("w") + F.lit(unseen)).alias("value"))
    return scratch.keep(known.unionByName(told))


def hot_grams(values: DataFrame) -> Lookup:
    """The values of the most common grams, at most HOT_GRAMS."""
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = {r.step: r.n for r in values.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()}  # at most 512 rows
    least, size = max(sizes, default=0) + 1, 0
    for k in sorted(sizes, reverse=True):
        size += sizes[k]
        if size > HOT_GRAMS:
            break
        least = k
    hot = values.where(step >= least).select("gram", "value").toArrow()  # at most HOT_GRAMS rows
    points = np.frombuffer("".join(hot["gram"].to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    return Lookup(gram_keys(points, np.arange(ORDER - 1, len(points), ORDER)), hot["value"].to_numpy())


SCORED = "row long, doc_id long, lang string, key long, part int, log_p double, n long, grams array<string>, times array<int>"


def perplexities(rows: DataFrame, good: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(doc_id, lang, key, log_p, n) of each of the rows; good: the ids of trusted ones."""
    values = gram_values(gram_counts(rows, good, scratch), scratch)
    shared = rows.sparkSession.sparkContext.broadcast(hot_grams(values))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, names = batch.column("text").to_pylist(), ["row", "doc_id", "lang", "key"]
        told = np.zeros(len(texts), np.int32)

        def batch_of(own, log_p, size, offsets, grams, times):
            part = told[own].copy()
            told[own] += 1
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, kind)) for x, kind in ((grams, pa.string()), (times, pa.int32()))]
            return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(own)) for c in names), pa.array(part, pa.int32()), pa.array(log_p), pa.array(size), *lists], names=[*names, "part", "log_p", "n", "grams", "times"])

        for points, ends, owner in places(texts, _PIECE):
            if not len(ends):
                continue
            keys = gram_keys(points, ends)
            value, found = shared.value.get(keys)
            first = _runs(owner)
            own, at = owner[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(owner))))
            log_p, size = np.bincount(at, value, len(own)), np.bincount(at, minlength=len(own))
            # the other grams of each text, each once with its number
            rest = np.flatnonzero(~found)
            rest = rest[np.lexsort((keys[rest], at[rest]))]
            first = np.union1d(_runs(keys[rest]), _runs(at[rest]))
            offsets = np.searchsorted(at[rest[first]], np.arange(len(own) + 1))
            yield batch_of(own, log_p, size, offsets, _grams(points, ends[rest[first]]), np.diff(np.append(first, len(rest))))
        none = np.flatnonzero(told == 0)
        if len(none):
            yield batch_of(none, np.zeros(len(none)), np.zeros(len(none), np.int64), np.zeros(len(none) + 1, np.int64), [], [])

    scored = scratch.keep(common.mapped(rows.withColumn("row", F.monotonically_increasing_id()), score, SCORED))
    rare = scored.select("row", F.explode(F.arrays_zip("grams", "times")).alias("g")).select("row", "g.grams", "g.times")
    more = rare.join(values.select(F.col("gram").alias("grams"), "value"), "grams").select("row", (F.col("times") * F.col("value")).alias("log_p"), F.lit(0).cast("long").alias("n"))
    # a document has a row for each of its parts, and the first one has its names
    more = more.unionByName(scored.where("part > 0").select("row", "log_p", "n")).groupBy("row").agg(F.sum("log_p").alias("more"), F.sum("n").alias("more_n"))
    both = scored.where("part = 0").select("row", "doc_id", "lang", "key", "log_p", "n").join(more, "row", "left")
    return both.select("doc_id", "lang", "key", (F.col("log_p") + F.coalesce("more", F.lit(0.0))).alias("log_p"), (F.col("n") + F.coalesce("more_n", F.lit(0))).alias("n"))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("key"), text.alias("text"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, lang, key (a hash of the text), perplexity, least, most and kept. labels: doc_id, and quality 1 for trusted text."""
    spark = docs.sparkSession
    common.small_batches(spark)
    scratch = common.Scratch(spark)
    rows = _rows(docs)
    good = scratch.keep(labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    held = held_out()
    scored = perplexities(rows, good, scratch)
    size = F.floor(F.log2(F.least(F.greatest(F.col("n"), F.lit(16)), F.lit(1 << 14)))).cast("int")
    scored = scratch.keep(scored.withColumn("perplexity", F.when(F.col("n") > 0, F.round(F.exp(-F.col("log_p") / F.col("n")), 6))).withColumn("size", size))
    known = scored.where("perplexity is not null").join(good, "doc_id", "left_semi")
    seen = F.percentile_approx("perplexity", [LOW, HIGH], 10_000)
    unseen = F.percentile_approx(F.when(held, F.col("perplexity")), HIGH, 10_000)
    # one row per language and length, per language, and in all: joined to every document, at most a few thousand rows
    of = known.rollup("lang", "size").agg(F.struct(seen[0].alias("low"), F.coalesce(unseen, seen[1]).alias("high")).alias("q"), F.count_if(held).alias("n_held"), F.grouping_id().alias("level"))
    few = F.sqrt(F.lit(float(LEAST_TRUSTED)) / F.greatest("n_held", F.lit(1)))
    slack = F.when((F.col("level") == 1) & (F.col("n_held") < LEAST_TRUSTED), 1 + (SLACK - 1) * few).otherwise(SLACK)
    of = of.withColumn("q", F.struct("q.low", "q.high", slack.alias("slack"), "n_held"))
    own = (F.col("level") == 1) & F.col("lang").isNotNull() | (F.col("level") == 3)
    of = of.where(own & F.col("q.low").isNotNull() | (F.col("n_held") >= LEAST_TRUSTED))
    out = scored
    for level, keys in ((0, ["lang", "size"]), (1, ["lang"]), (3, [])):
        part = of.where(F.col("level") == level).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("q").alias(f"q{level}"))
        out = out.join(part, [out[k].eqNullSafe(part[f"_{k}"]) for k in keys], "left") if keys else out.join(part, F.lit(True), "left")
    q = F.coalesce("q0", "q1", "q3")
    least, most = q["low"] / q["slack"], F.when(q["n_held"] > 0, q["high"]).otherwise(F.greatest(q["high"], F.col("q3")["high"])) * q["slack"]
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity").between(least, most), F.lit(True))
    return out.select("doc_id", "lang", "key", "perplexity", least.alias("least"), most.alias("most"), kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the model doesn't reject."""
    gone = quality(docs, labels).where("not kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (key == gone["_key"]), "left_anti")
