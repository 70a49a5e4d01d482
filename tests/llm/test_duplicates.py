"""Near duplicates, line dedup and decontamination against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from contrata.llm import common, contamination, lines, minhash, shingles

from .conftest import corpus, prose


def words_of(text):
    return tuple((text or "").encode().lower().split())


def set_of(text, width=5):
    words = words_of(text)
    return {words[i : i + width] for i in range(len(words) - width + 1)} if len(words) >= width else ({words} if words else set())


def similar(a, b):
    common_ = len(a & b)
    return bool(a) and bool(b) and 100 * common_ >= 75 * (len(a) + len(b) - common_)


def brute_components(rows):
    sets = [(i, set_of(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and similar(a, b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets]


def test_shingle_sets_are_those_of_the_words():
    texts = [t for _, t in corpus()] + ["Ünï  çode\x0bÄ\x1fx y z w", "a" * 5000, "\x00 b c d e f"]
    sets = shingles.shingle_sets(pa.array(texts))
    known = defaultdict(set)
    for text, found in zip(texts, sets, strict=True):
        wanted = set_of(text)
        assert len(found) == len(wanted)
        for s in wanted:
            known[s]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(set_of(texts[i]) & set_of(texts[j]))


@pytest.mark.parametrize("least", [0, 1000])
def test_near_duplicates_equal_brute_force(documents, spark, monkeypatch, least):
    monkeypatch.setattr(common, "LEAST_HOT", least)
    got = sorted(map(str, (tuple(r) for r in minhash.near_duplicates(documents).collect())))
    assert got == sorted(map(str, brute_components(corpus())))


def test_near_duplicates_of_the_small_table(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs).collect()) == sorted(brute_components(rows))


def test_near_duplicates_that_differ_from_the_centre_meet_in_blocks(spark, monkeypatch):
    """A long chain: each text is similar to its neighbours only, and blocks are tiny."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    words = prose(3, 900).split()
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs).collect()) == sorted(brute_components(rows))


def test_keep_one_has_all_columns(documents, nothing):
    kept = minhash.keep_one(documents)
    assert kept.columns == documents.columns
    wanted = sorted(i for i, _, _, keep in brute_components(corpus()) if keep and i is not None)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == wanted
    assert minhash.keep_one(nothing).count() == 0 and minhash.near_duplicates(nothing).count() == 0


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.75, 0.9):
        both = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        own = int(4000 * (1 - share) / (1 + share))
        a = np.concatenate([both[own:], rng.integers(0, 1 << 63, own, dtype=np.uint64)])
        sketches = minhash.odd_sketches(np.stack([minhash.samples(both), minhash.samples(a)])).view(np.uint64)
        differing = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        expected = 256 * (1 - (1 - 2 / 512) ** (256 * (1 - share)))
        assert abs(differing - expected) < 35
        assert (differing <= minhash.most_differing()) == (share > 0.55)


def test_sketches_of_sets_never_leave_out_a_similar_pair():
    rng = np.random.default_rng(2)
    for n in (4, 40, 400, 4000):
        differing = []
        for _ in range(200):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            own = int(n * 0.25 / 1.75)
            a = np.concatenate([both[own:], rng.integers(0, 1 << 63, own, dtype=np.uint64)])
            x, y = (np.frombuffer(b, np.uint64) for b in minhash.set_sketches([both, a]))
            differing.append(int(np.bitwise_count(x ^ y).sum()))
        most = minhash.most_differing_sets(np.array([2 * n]))[0]
        assert max(differing) <= most
        if 400 <= n < 4000:
            far = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            far[: n * 3 // 4] = both[: n * 3 // 4]  # a similarity of 0.6
            x, y = (np.frombuffer(b, np.uint64) for b in minhash.set_sketches([both, far]))
            assert np.bitwise_count(x ^ y).sum() > most


def brute_lines(rows):
    """Windows as they are stated; rows with one doc_id go by their text's hash, which the caller's rows mustn't depend on."""
    seen = {}
    place = lambda i, t: (i is not None, i or 0, t or "")

    def windows(t):
        own = (t or "").split("\n")
        n = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in own]
        for p in range(len(own)):
            if p + 3 <= len(own) and "".join(own[p : p + 3]).strip(" "):
                yield p, tuple(own[p : p + 3])
            if n[p] > 50:
                yield p, (own[p],)
            elif p + 1 < len(own) and n[p + 1] <= 50 < n[p] + n[p + 1]:
                yield p, tuple(own[p : p + 2])

    for i, t in rows:
        for p, w in windows(t):
            seen[w] = min(seen.get(w, ((2,),)), (place(i, t), p))
    gone = defaultdict(set)
    for i, t in rows:
        for p, w in windows(t):
            if i is not None and (place(i, t), p) > seen[w]:
                gone[i, t or ""] |= set(range(p, p + len(w)))
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for p, x in enumerate(own) if p not in gone.get((i, t or ""), ())]
        out.append((i, t if (i, t or "") not in gone else "\n".join(kept), len(own), len(kept)))
    return out


def test_line_dedup_equals_brute_force(spark, documents, nothing):
    extra = [(500, "a\na\na\na\na\na"), (501, "\n\n\n\n"), (502, "x\na\na\na\ny"), (503, "p\nq\nr\ns"), (504, "q\nr\ns\nt\nu\nv"), (505, "s\nt\nu\nv\nq\nr\ns"), (506, "\n\n\n\n")]
    # rows that share a doc_id: what one loses the other keeps
    extra += [(507, "p\nq\nr\nz"), (507, "own one\nown two\nown three\nown four"), (508, "a\nk"), (508, "a\nk")]
    # long passages on one line or two, beside other neighbours, in short documents, and just too short
    long = " ".join(f"w{i}" for i in range(51))
    extra += [(510, long), (511, f"one\n{long}\ntwo"), (512, f"three\n{long}"), (513, f"{long} more\nx"), (514, long.removesuffix(" w50")), (515, long.removesuffix(" w50"))]
    half = [" ".join(f"{c}{i}" for i in range(26)) for c in "gh"]
    extra += [(516, "\n".join(["m", *half, "n"])), (517, "\n".join([*half, "o"])), (518, f"{half[0]}\nother\n{half[1]}")]
    rows = corpus() + extra
    clash = ("places", "_n_lines", "_n_kept", "__gone_id", "gone_id", "key", "row", "lines", "n", "first", "h1", "__value", "__part")
    docs = spark.createDataFrame([(i, t, *clash) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    out = lines.line_dedup(docs)
    assert out.columns == ["doc_id", "text", *[c for c in clash if not c.startswith("_n_")], "_n_lines", "_n_kept"]
    got = [(r.doc_id, r.text, r._n_lines, r._n_kept) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_lines(rows)))
    assert {r["__gone_id"] for r in out.select("__gone_id").collect()} == {"__gone_id"}
    assert lines.deduplicated(docs).columns == docs.columns and {r._n_lines for r in lines.deduplicated(docs).collect()} == {"_n_lines"}
    assert lines.deduplicated(nothing).count() == lines.deduplicated(nothing, keep_emptied=False).count() == 0
    assert lines.deduplicated(documents).columns == documents.columns
    emptied = sum(1 for (_, t), (_, after, *_) in zip(rows, brute_lines(rows), strict=True) if after != t and not after.strip())
    assert emptied and lines.deduplicated(docs, keep_emptied=False).count() == len(rows) - emptied


@pytest.mark.parametrize("least", [0, 100, 1000])
def test_hot_keys_are_looked_up_like_others(spark, monkeypatch, least):
    """One key has half of the rows, one has no value, and some are null."""
    monkeypatch.setattr(common, "LEAST_HOT", least)
    rows = [(i, 0 if i % 2 else i % 7, f"s{i % 3}" if i % 5 else None) for i in range(500)]
    big = spark.createDataFrame([(i, k if i % 11 else None, s) for i, k, s in rows], "i long, k long, s string")
    small = spark.createDataFrame([(0, "s1", "v01"), (0, "s2", "v02"), (3, "s0", "v30"), (9, "s0", "x")], "k long, s string, v string")
    known = {(r.k, r.s): r.v for r in small.collect()}
    wanted = sorted((i, known.get((k if i % 11 else None, s), "")) for i, k, s in rows)
    got = common.looked_up(big, small, ["k", "s"], "v", how="left").collect()
    assert sorted((r.i, r.v or "") for r in got) == wanted
    assert sorted((r.i, r.v) for r in common.looked_up(big, small, ["k", "s"], "v").collect()) == [w for w in wanted if w[1]]
    hot = common.hot_keys_of(big, ["k"])
    assert len(hot) == {0: 8, 100: 1, 1000: 0}[least] and (least > 0 or max(hot.values()) > 400)
    texts = [(0, "zero"), (0, "again"), (3, "three")]
    met = common.met(big.select("i", "k"), spark.createDataFrame(texts, "k long, text string"), ["k"], hot, ["i"])
    assert sorted((r.i, r.text) for r in met.collect()) == sorted((i, t) for i, k, _ in rows if i % 11 for j, t in texts if j == k)


def items():
    long = prose(77, 20_000).split()
    return [(0, " ".join(long[500:540])), (1, " ".join(long[900:980])), (1, prose(6, 30)), (2, "one two"), (3, ""), (4, None), (None, " ".join(long[40:90])), (5, "nowhere to be found in any of these texts at all"), (6, prose(999, 60).upper()), (7, "ONE"), (8, " ".join(long[70:73])), (9, " ".join(long[:4])), (10, "one three")]


@pytest.mark.parametrize("block", [4 << 20, 100])
def test_contamination_equals_brute_force(spark, documents, nothing, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK_SHINGLES", block)
    benchmark = spark.createDataFrame([(i, t, 9) for i, t in items()], "item_id long, text string, doc_id int")
    got = sorted(str(tuple(r)) for r in contamination.contained_items(documents, benchmark).collect())
    wanted, hit = [], set()
    for i, t in corpus():
        for j, q in items():
            width = min(5, len(words_of(q)))
            q, own = set_of(q), set_of(t, width) if width else set()
            if q and 100 * len(own & q) >= 75 * len(q):
                wanted.append((i, j, len(q), len(own & q)))
                hit.add((i, t))
    assert len(wanted) > 30 and got == sorted(map(str, wanted))
    clean = contamination.decontaminate(documents, benchmark)
    assert clean.columns == documents.columns
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(str(row) for row in corpus() if row not in hit)
    assert contamination.contained_items(nothing, benchmark).count() == 0
    assert contamination.contained_items(documents, benchmark.limit(0)).count() == 0
    assert contamination.decontaminate(documents, benchmark.limit(0)).count() == documents.count()
