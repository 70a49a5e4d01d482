"""Cases of the second round's findings."""

import random
import time

from pyspark.sql import functions as F

from contrata.operators import matching, windows
from contrata.sources import gazette


def test_concentration_doesnt_round_shares(spark):
    totals = spark.createDataFrame([(1, "5000004.00"), (2, "4999996.00")], "k int, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert windows.concentration(totals, "k", "v").collect() == []
    assert [r.k for r in windows.concentration(totals, "k", "v", 0.5000004).collect()] == [1]


def test_officers_of_a_long_text_take_no_square_of_its_length(spark):
    body = ". Nombramientos. Adm. Unico: PEREZ LOPEZ ANA. Ceses/Dimisiones. Apoderado: SOLO GIL EVA. " + "objeto social largo " * 4000
    began = time.monotonic()
    got = gazette.officers(spark.createDataFrame([(1, body)], "k int, cuerpo string")).collect()
    assert [(r.persona, r.cargo, r.tipo_acto) for r in got] == [("PEREZ LOPEZ ANA", "Adm. Unico", "nombramiento"), ("SOLO GIL EVA", "Apoderado", "cese")]
    assert time.monotonic() - began < 20


def test_assignment_over_two_keys_equals_the_serial_loop(spark):
    r = random.Random(8)
    left = [(i, f"n{r.randrange(5)}", f"f{r.randrange(4)}", 2020 + r.randrange(3), r.choice((90_000.0, 100_000.0, 104_000.0, 107_000.0))) for i in range(120)]
    right = [(i, f"n{r.randrange(5)}", f"f{r.randrange(4)}", 2020 + r.randrange(3), r.choice((91_000.0, 100_000.0, 102_000.0))) for i in range(90)]
    used, wanted = set(), set()
    for i, nif, file, year, amount in left:
        fits = []
        for j, n, f, y, a in right:
            if j not in used and abs(a - amount) <= max(0.1 * amount, 5_000.0):
                if n == nif and abs(y - year) <= 1:
                    fits.append((1, abs(a - amount), [0, 1, -1].index(y - year), j))
                if f == file:
                    fits.append((2, abs(a - amount), 0, j))
        if fits:
            used.add(min(fits)[3])
            wanted.add((i, min(fits)[3], min(fits)[0]))
    frames = [spark.createDataFrame(rows, f"{name}_ord long, nif string, file string, year int, amount double") for name, rows in (("left", left), ("right", right))]
    nif, file = F.col("nif"), F.col("file")
    got = matching.assign(*frames, [(nif, nif, [0, 1, -1]), (file, file, None)]).collect()
    assert {(g.left_ord, g.right_ord, g.tier) for g in got} == wanted and len(got) == len(wanted) and {t for _, _, t in wanted} == {1, 2}


def test_parser_report_parses_each_text_once(spark):
    one = "12345 - EMPRESA UNO SL.\nConstitución. Nombramientos. Adm. Unico: PEREZ LOPEZ ANA;GARCIA RUIZ LUIS. Apoderado: RUIZ PAZ EVA. Ceses/Dimisiones. Liquidador: X. Artículo de los estatutos: UNO DOS. Apoderado: SOLO GIL EVA. Datos registrales. T 1.\n"
    two = "12346 - " + "MUY LARGO " * 16 + "SA. Reelecciones.  Consejero: UNO\tDOS. Secretario muy largo y lejano: TRES. Otros conceptos: NADA.\r\n"
    pages = spark.createDataFrame([(1, "Empresarios\n" + one + two), (2, one.replace("1234", "8234")), (3, None)], "k int, body string")
    report = gazette.parser_report(gazette.entries(pages, "k", "body"))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(") == 1 and plan.count("Generate ") == 2 and "Union" not in plan
    wanted = {("body", "Constitución"): 2, ("body", "Reelecciones"): 1, ("long_name", ("MUY LARGO " * 16 + "SA")): 1, ("missed", "Secretario muy largo y lejano"): 1}
    wanted |= {("office", "Adm. Unico"): 4, ("office", "Apoderado"): 4, ("office", "Consejero"): 1, ("kind", "nombramiento"): 6, ("kind", "cese"): 2, ("kind", "reeleccion"): 1}
    assert {(r.measure, r.value): r.n for r in report.collect()} == wanted
    # a filter on what is told runs no pattern a second time
    few = report.where("measure = 'kind'")
    assert few._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == plan.count("regexp_extract_all") and few.count() == 3


def test_officers_of_one_text_take_no_square_of_their_number(spark):
    sections = ["", "Ceses/Dimisiones. ", "", "texto Reelecciones en el registro. ", ""]
    body = "".join(f". {sections[i % 5]}Cargo: UNO N{i};DOS N{i}. x" for i in range(20_000))
    began = time.monotonic()
    got = gazette.officers(spark.createDataFrame([(1, body)], "k int, cuerpo string")).select("persona", "cargo", "tipo_acto").collect()
    kinds = ["reeleccion", "cese", "cese", "reeleccion", "reeleccion"]
    assert [(r.persona, r.cargo, r.tipo_acto) for r in got] == [(f"{p} N{i}", "Cargo", kinds[i % 5] if i else "nombramiento") for i in range(20_000) for p in ("UNO", "DOS")]
    assert time.monotonic() - began < 20
