"""The parallel assignment equals the serial loop, plain and grouped."""

import random

import numpy as np
import pytest

from contrata.operators import matching, windows
from contrata.plans import coverage, health


def serial(pairs):
    """Left rows in order, each the free candidate with the smallest (diff, step, right)."""
    used, out = set(), []
    by_left = {}
    for left, right, diff, step in pairs:
        by_left.setdefault(left, []).append((diff, step, right))
    for left in sorted(by_left):
        free = [c for c in by_left[left] if c[2] not in used]
        if free:
            best = min(free)
            used.add(best[2])
            out.append((left, best[2]))
    return sorted(out)


def test_parallel_rounds_equal_the_serial_loop(spark):
    r = random.Random(1)
    for size in (3, 12, 40):
        pairs = sorted({(r.randrange(size), 100 + r.randrange(size), float(r.randrange(4)), r.randrange(3)) for _ in range(size * 4)})
        frame = spark.createDataFrame(pairs, "left_ord long, right_ord long, diff double, step int")
        got = matching.greedy(frame, ["diff", "step"]).collect()
        assert sorted((x.left_ord, x.right_ord) for x in got) == serial(pairs)


def test_order_dependence(spark):
    left = spark.createDataFrame([(1, "N1", 2020, 100_000.0), (2, "N1", 2020, 104_000.0)], "left_ord long, nif string, year int, amount double")
    right = spark.createDataFrame([(7, "N1", 2020, 104_000.0)], "right_ord long, nif string, year int, amount double")
    got = matching.greedy(matching.near_amounts(left, right, "nif", [0, 1, -1]), ["diff", "step"]).collect()
    assert [(x.left_ord, x.right_ord) for x in got] == [(1, 7)]


def test_floor_of_the_tolerance_and_year_window(spark):
    left = spark.createDataFrame([(1, "N", 2020, 10_000.0)], "left_ord long, nif string, year int, amount double")
    right = spark.createDataFrame([(1, "N", 2021, 15_000.0), (2, "N", 2019, 5_000.0), (3, "N", 2022, 10_000.0), (4, "N", 2020, 15_000.5), (5, "", 2020, 10_000.0)], "right_ord long, nif string, year int, amount double")
    pairs = matching.near_amounts(left, right, "nif", [0, 1, -1]).collect()
    assert sorted((p.right_ord, p.step) for p in pairs) == [(1, 1), (2, 2)]
    assert [p.right_ord for p in matching.greedy(matching.near_amounts(left, right, "nif", [0, 1, -1]), ["diff", "step"]).collect()] == [1]
    assert [p.right_ord for p in matching.greedy(matching.near_amounts(left, right, "nif", [0, -1, 1]), ["diff", "step"]).collect()] == [2]


def grouped_serial(pairs):
    used, out = set(), []
    by_left = {}
    for left, right, diff, step, by_name in pairs:
        by_left.setdefault(left, []).append((diff, step, by_name, right))
    for left in sorted(by_left):
        best = None
        for step in range(3):
            for by_name in (0, 1):
                if by_name and best is not None:
                    continue
                for c in sorted(by_left[left]):
                    if c[1] == step and c[2] == by_name and c[3] not in used and (best is None or c[0] < best[0]):
                        best = c
        if best:
            used.add(best[3])
            out.append((left, best[3]))
    return sorted(out)


def test_grouped_choice_equals_the_serial_loop(spark):
    r = random.Random(4)
    for size in (4, 10):
        pairs = {}
        for _ in range(size * 3):
            left, right = r.randrange(size), 100 + r.randrange(size)
            pairs[left, right] = (left, right, r.random(), r.randrange(3), r.randrange(2))
        rows = sorted(pairs.values())
        frame = spark.createDataFrame(rows, "left_ord long, right_ord long, diff double, step int, by_name int")
        got = matching.greedy(frame, ["diff", "step", "by_name"], choose=coverage._grouped_choice).collect()
        assert sorted((x.left_ord, x.right_ord) for x in got) == grouped_serial(rows)


LEFT = "left_ord long, nif string, nif_organo string, organo string, expediente string, year int, amount double, is_sara boolean, sara_by_lots boolean, neg_sin_pub boolean"
RIGHT = "right_ord long, notice_id string, win_nif string, cae_nif string, cae_name string, internal_id string, year int, amount double, total_value double, estimated_value double"


def test_strategies(spark):
    left = [
        (1, "ESA1111111", "B00001", "Buyer uno", "EXP-1", 2020, 100_000.0, True, False, False),
        (2, "X9999999", "B00002", "Buyer dos", "exp-2", 2020, 50_000.0, True, False, False),
        (3, "Z0000001", "B00003", "Buyer tres", "EXP-3", 2020, 1.0, True, True, False),
        (4, "Z0000002", "B00003", "Buyer tres", "EXP-3", 2020, 2.0, True, True, False),
        (5, "Z0000003", "B00004", "Buyer cuatro", "EXP-5", 2020, 70_000.0, True, False, False),
        (6, "Z0000004", "", "Ayuntamiento de Lugo", "EXP-6", 2020, 90_000.0, True, False, False),
        (7, "Z0000005", "", "Nombre Raro", "EXP-7", 2020, 90_000.0, True, False, False),
        (8, "Z0000006", "", "Hospital Clinico Universitario Santiago", "EXP-8", 2020, 80_000.0, True, False, False),
        (9, "Z0000007", "", "Sin Nada", "EXP-6", 2020, 333.0, True, False, False),
        (10, "Z0000008", "B00010", "Grupo", "EXP-A", 2020, 100_000.0, True, False, False),
        (11, "Z0000009", "B00010", "Grupo", "EXP-B", 2020, 200_000.0, True, False, False),
        (12, "Z0000010", "B00012", "Otro", "EXP-C", 2020, 60_000.0, True, False, True),
        (13, "A1111111", "B00001", "Buyer uno", "EXP-1b", 2020, 100_000.0, False, False, False),
    ]
    right = [
        (1, "n1", "A1111111", "", "", "EXP-2", 2020, 104_000.0, None, None),
        (2, "n2", "", "", "", "EXP-2", 2020, 52_000.0, None, None),
        (3, "n3", "", "", "", "EXP-3", 2020, None, None, None),
        (4, "n4", "", "ES-B00004", "", "", 2019, 71_000.0, None, None),
        (5, "n5", "", "", "AYUNTAMIENTO DE LUGO.", "", 2021, 90_500.0, None, None),
        (6, "n6", "", "", "Alias del raro", "", 2020, 91_000.0, None, None),
        (7, "n7", "", "", "Santiago: Hospital Universitario (Clinico)", "", 2020, 82_000.0, None, None),
        (8, "n8", "", "B00010", "", "", 2020, None, 330_000.0, None),
        (9, "n9", "", "B00012", "", "", 2020, 60_000.0, None, None),
        (10, "n1", "", "B00004", "", "", 2020, 70_000.0, None, None),
    ]
    aliases = spark.createDataFrame([("NOMBRE RARO", "ALIAS DEL RARO")], "organo string, alias string")
    got = coverage.matched(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), aliases).collect()
    assert sorted((r.left_ord, r.right_ord, r.strategy) for r in got) == [(1, 1, "E1"), (2, 2, "E2"), (3, 3, "E2b"), (4, 3, "E2b"), (5, 4, "E3"), (6, 5, "E5"), (7, 6, "E3b"), (8, 7, "E7"), (9, 5, "E6"), (10, 8, "E4"), (11, 8, "E4")]
    rows = coverage.with_matches(spark.createDataFrame(left, LEFT).withColumn("threshold", __import__("pyspark").sql.functions.lit(50_000.0)), coverage.matched(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), aliases))
    assert [r.left_ord for r in rows.where("missing_all").collect()] == [12] and not rows.where("missing").count()
    assert coverage.by_file(rows).first().matched == 9
    assert coverage.by_year(rows, spark.createDataFrame(right, RIGHT)).first().rate == 91.7


def test_blocks_equal_the_serial_loop(spark, monkeypatch):
    """Small blocks in one task each, large ones in rounds, as one serial loop over all."""
    r = random.Random(4)
    pairs = sorted({(b * 100 + r.randrange(20), b * 100 + 50 + r.randrange(20)) for b in range(6) for _ in range(40 if b % 2 else 120)})
    rows = [(f"b{a // 100}", a, b, float(r.randrange(5)), r.randrange(3)) for a, b in pairs]
    wanted = set(serial([(a, b, d, s) for _, a, b, d, s in rows]))
    for most in (1, 50, 1 << 21):
        monkeypatch.setattr(matching, "MOST_PAIRS", most)
        got = matching.greedy(spark.createDataFrame(rows, "k string, left_ord long, right_ord long, diff double, step int"), ["diff", "step"], block="k").collect()
        assert {(g.left_ord, g.right_ord) for g in got} == wanted


def near(limits, a, b):
    return abs(a - b) <= max(a * limits[0], limits[1])


def test_buckets_lose_no_pair(spark):
    r = random.Random(5)
    for limits in ((0.10, 5_000.0), (0.15, 20_000.0), (0.15, 10_000.0)):
        edge = limits[1] / limits[0]
        amounts = [r.uniform(1, 3 * edge) for _ in range(150)] + [edge, edge * 0.9, edge * 1.1, limits[1], 1.0, 1e9, 1.1e9, 0.9e9, 50_000.0, 55_000.0, 45_000.0]
        left = spark.createDataFrame([(i, "k", 2020, a) for i, a in enumerate(amounts)], "left_ord long, k string, year int, amount double")
        right = spark.createDataFrame([(i, "k", 2020, a) for i, a in enumerate(amounts)], "right_ord long, k string, year int, amount double")
        got = {(g.left_ord, g.right_ord) for g in matching.near_amounts(left, right, "k", [0], limits).collect()}
        assert got == {(i, j) for i, a in enumerate(amounts) for j, b in enumerate(amounts) if near(limits, a, b)}


def test_words_of_three_letters_count_but_find_nothing(spark):
    words = lambda n, least: [w for w in n.split() if len(w) > least]
    names = ["HOSPITAL SAN JUAN SUR", "HOSPITAL SAN JUAN RIO", "CAJA SAN SUR RIO", "HOSPITAL NORTE", "SAN SUR RIO MAR"]
    left = spark.createDataFrame([(i, words(n, 3), words(n, 2), 2020, 100_000.0) for i, n in enumerate(names)], "left_ord long, tokens array<string>, words array<string>, year int, amount double")
    right = spark.createDataFrame([(i, words(n, 3), words(n, 2), 2021, 104_000.0) for i, n in enumerate(names)] + [(9, words(names[0], 3), words(names[0], 2), 2022, 100_000.0), (8, words(names[0], 3), words(names[0], 2), 2020, 120_000.0)], "right_ord long, tokens array<string>, words array<string>, year int, amount double")
    got = {(g.left_ord, g.right_ord) for g in matching.near_words(left, right, "tokens", "words", 0.6, 3).collect()}
    wanted = set()
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            x, y = set(words(a, 2)), set(words(b, 2))
            if set(words(a, 3)) & set(words(b, 3)) and len(x & y) >= 3 and len(x & y) >= 0.6 * min(len(x), len(y)):
                wanted.add((i, j))
    assert got == wanted and (0, 1) in wanted and (4, 4) not in wanted


def test_simple_validation_equals_the_serial_loop(spark):
    r = random.Random(6)
    contracts = [(i, f"A{r.randrange(6):08d}", f"EXP{r.randrange(8)}" if r.random() < 0.8 else "x", 2010 + r.randrange(4), r.choice((120_000.0, 150_000.0, 160_000.0, 400_000.0)) + i, r.random() < 0.1) for i in range(80)]
    notices = [(i, f"es-A{r.randrange(6):08d}", f"exp{r.randrange(8)}", 2010 + r.randrange(4), r.choice((145_000.0, 160_000.0, 390_000.0)) + i) for i in range(60)]
    left = spark.createDataFrame(contracts, "left_ord long, nif string, expediente string, year int, amount double, is_minor boolean")
    right = spark.createDataFrame(notices, "right_ord long, win_nif string, internal_id string, year int, amount double")
    used, wanted = set(), {}
    for i, nif, file, year, amount, _ in contracts:
        if amount < 140_000:
            continue
        for strategy in ("nif", "file"):
            fits = []
            for j, win, internal, y, a in notices:
                same = win.upper().removeprefix("ES-") == nif and abs(y - year) <= 1 if strategy == "nif" else len(file) >= 4 and internal.upper() == file
                if same and j not in used and near((0.10, 5_000.0), amount, a):
                    fits.append((abs(a - amount), {0: 0, 1: 1, -1: 2}[y - year] if strategy == "nif" else 0, j))
            if fits:
                used.add(min(fits)[2])
                wanted[i] = strategy
                break
    got = {r.left_ord: r for r in coverage.simple_validation(left, right).collect()}
    assert {i: g.strategy for i, g in got.items() if g.strategy} == wanted and set(wanted.values()) == {"nif", "file"}
    for i, _, _, _, amount, minor in contracts:
        assert got[i].missing == (amount >= 140_000 and i not in wanted and not minor)


def test_recoverable_takes_the_first_free_notice_by_year(spark):
    rows = [(i, "B", 2020, 100_000.0 + 1000 * i) for i in range(6)] + [(9, "C", 2020, 1.0)]
    notices = [(20, "B", 2021, 100_000.0), (21, "B", 2020, 90_000.0), (22, "B", 2019, 100_000.0), (23, "B", 2020, 101_000.0), (24, "C", 2020, 20_000.0)]
    used, wanted = set(), set()
    for i, k, year, amount in rows:
        for y in (year, year - 1, year + 1):
            fit = next((j for j, n, at, a in notices if j not in used and n == k and at == y and near((0.15, 10_000.0), amount, a)), None)
            if fit:
                used.add(fit)
                wanted.add((i, fit))
                break
    got = coverage.recoverable(spark.createDataFrame(rows, "left_ord long, name string, year int, amount double"), spark.createDataFrame(notices, "right_ord long, name string, year int, amount double"), "name")
    assert {(g.left_ord, g.right_ord) for g in got.collect()} == wanted


def test_patterns_of_lots_have_the_limits_of_the_rules(spark):
    def group(buyer, n, files, spread):
        return [(buyer, 2020, 1000.0 + (spread if i % 2 else 0), "A", f"f{i % files}") for i in range(n)]

    rows = group("few files", 10, 2, 0) + group("three in ten", 10, 3, 0) + group("varied", 5, 5, 9000) + group("four", 4, 1, 0) + group("two", 2, 2, 9000) + group("one", 1, 1, 0)
    got = {r.organo_contratante: r.pattern for r in health.lot_patterns(spark.createDataFrame(rows, "organo_contratante string, ano int, importe_adjudicacion double, nif_adjudicatario string, expediente string")).collect()}
    assert got == {"few files": "lotes_mismo_expediente", "three in ten": "acuerdo_marco_homogeneo", "varied": "contratos_recurrentes", "four": "grupo_pequeno", "two": "grupo_pequeno", "one": "individual"}


def test_group_percentiles_equal_the_definition(spark):
    r = random.Random(9)
    groups = {None: [5.0], "a": [r.choice((-3.0, 0.0, 0.5, 1e9)) for _ in range(101)], "b": [r.uniform(-1e3, 1e6) for _ in range(400)], "c": [7.0, 7.0]}
    rows = [(g, x, -x if x > 0 else None) for g, xs in groups.items() for x in xs] + [("c", None, None), ("d", None, 1.0)]
    got = {r.g: r for r in windows.group_percentiles(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], {"p1": ("x", 0.01), "p50": ("x", 0.5), "p99": ("x", 0.99), "y50": ("y", 0.5)}).collect()}
    for g, xs in groups.items():
        for name, share in (("p1", 1), ("p50", 50), ("p99", 99)):
            assert got[g][name] == pytest.approx(np.percentile(xs, share))
        assert got[g].y50 == pytest.approx(np.percentile([-x for x in xs if x > 0], 50))
    assert got["d"].p50 is None and got["d"].y50 == 1.0
