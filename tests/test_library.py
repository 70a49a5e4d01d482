"""Scalar functions, quality indicators, readers, sinks, layouts and incremental state on small fixtures."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from contrata.functions import identifiers, text, values
from contrata.operators import reshape, windows
from contrata.plans import companies, quality
from contrata.sources import feeds, gazette, layouts, readers, sinks
from contrata.streaming import incremental


def apply(spark, function, inputs, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_identifiers(spark):
    ids = ["12345678Z", "12345678A", "X1234567L", "A58818501", "a-5881.8501", "A58818502", "a@b.es", None, "1234567", "K1234567A"]
    assert apply(spark, identifiers.valid_nif, ids) == [True, False, True, True, True, False, False, False, False, False]
    codes = ["42933300.0", "9000000", "33600000-6", "abc", None, "123456789", "0", "", "1-x"]
    assert apply(spark, identifiers.valid_cpv, codes) == [True, True, True, False, False, False, True, False, True]
    assert apply(spark, identifiers.cpv_division, ["9000000", "abc", None, "33600000-6"]) == ["09", "", "", "33"]
    assert apply(spark, identifiers.valid_nuts, ["ES111", "es", " ES30 ", "FR1", None, "ES1111"]) == [True, True, True, False, False, False]
    assert apply(spark, identifiers.clean_nif, ["ES-A1234", " esb99999", "A12", None]) == ["A1234", "B99999", "", ""]
    assert apply(spark, identifiers.pick_nif, [["123", "A12345678", "B12345678"], ["1", "2"], []], "array<string>") == ["A12345678", "2", None]


def test_threshold(spark):
    rows = [(2015, "Obras", False, False, 5_186_000.0), (2024, "Servicios", True, False, 143_000.0), (2024, "Suministros", True, True, 443_000.0), (1999, "Servicios", False, False, 216_000.0), (2024, "Privado", False, False, None), (2024, "Otros", True, True, 221_000.0), (2024, None, False, False, None)]
    got = spark.createDataFrame(rows, "y int, t string, s boolean, u boolean, w double").select(identifiers.threshold(F.col("y"), F.col("t"), F.col("s"), F.col("u")).alias("a"), "w").collect()
    assert all(r.a == r.w for r in got)


def test_names(spark):
    assert apply(spark, text.company_key, ["CONSTRUCCIONES PEÑA, S.L.U.", "Marfina SL (Moventis)", "Acería S. A.", None, "X SA Sociedad Unipersonal"]) == ["CONSTRUCCIONES PEÑA", "MARFINA", "ACERIA", "", "X"]
    assert apply(spark, text.company_key_anywhere, ["GRUPO SANITAS", None]) == ["GRUPONITAS", ""]
    assert apply(spark, text.buyer_key, ["Alcaldía de A-Coruña (Sede)", None]) == ["ALCALDIA DE A CORUNA SEDE", ""]
    assert apply(spark, text.label_key, [" Órgano de contratación: "]) == ["organo_de_contratacion"]
    assert apply(spark, text.without_tags, ["<p>Contrato <b>de</b>\n prueba</p>"]) == ["Contrato de prueba"]
    assert apply(spark, text.record_id, ["12.0", "a"]) == ["12", "a"]
    assert apply(spark, lambda x: text.salted_hash(x, "s"), [" ana ", "ANA", "", None])[:2] == [apply(spark, lambda x: text.salted_hash(x, "s"), ["ANA"])[0]] * 2
    assert apply(spark, identifiers.is_state, ["Ministerio de Sanidad", "ADIF Ministerio", "Concello", None]) == [True, False, False, False]


def test_numbers_and_dates(spark):
    assert apply(spark, values.mixed_number, ["1.234,56", "12,5", "12.5", "", None, "1.234,56 €", "nan", "12f"]) == [1234.56, 12.5, 12.5, None, None, 1234.56, None, None]
    assert apply(spark, values.spanish_number, ["Total: 1.234,56 €", "12.5", "x"]) == [1234.56, 125.0, None]
    days = apply(spark, lambda x: F.date_format(values.timestamp(x), "yyyy-MM-dd HH:mm"), ["2026-03-23T14:31:00+0100", "23/3/2026", "23-03-2026", "2026-03-24", "mañana", None, "2026-03-23T14:31:00.5Z", "2026-03-24+01:00"])
    assert days == ["2026-03-23 14:31", "2026-03-23 00:00", "2026-03-23 00:00", "2026-03-24 00:00", None, None, "2026-03-23 14:31", "2026-03-24 00:00"]
    assert apply(spark, values.day_prefix, ["2026-03-23T14:31:00+0100", None]) == ["2026-03-23", ""]


CONTRACT = "id string, expediente string, url string, importe_sin_iva double, importe_adjudicacion double, num_ofertas double, estado string, tipo_contrato string, conjunto string, cpv_principal string, fecha_publicacion timestamp, fecha_limite timestamp"


def test_indicators_keep_three_values(spark):
    import datetime as dt

    day = dt.datetime(2020, 1, 1)
    rows = [
        ("1", "E", "u", 100.0, 105.0, 2.0, "Adjudicada", "Servicios", "menores", "33600000", day, day + dt.timedelta(365)),
        ("2", None, "u", float("nan"), 15_000.01, 2.5, "Publicada", "Servicios", "menores", "33600000", day, day + dt.timedelta(366)),
        ("3", "E", None, None, 40_000.0, -1.0, "Adjudicada", "Obras", "menores", "abc", dt.datetime(1989, 12, 31), None),
        ("4", "E", None, None, None, None, "Resuelta", "Obras", "x", None, None, None),
        ("5", "E", None, 100.0, 106.0, 0.0, None, None, None, None, day, day - dt.timedelta(1)),
    ]
    got = {r.id: r for r in quality.with_score(quality.with_indicators(spark.createDataFrame(rows, CONTRACT))).collect()}
    assert [got[i].val_01 for i in "12345"] == [True, False, False, False, True]
    assert [got[i].val_03 for i in "124"] == [True, True, True]
    assert [got[i].val_04 for i in "1234"] == [True, False, True, True] and [got[i].val_05 for i in "134"] == [True, False, True]
    assert [got[i].val_06 for i in "134"] == [True, False, False]
    assert [got[i].val_14 for i in "12345"] == [True, False, True, True, True]
    assert [got[i].cons_01 for i in "12345"] == [True, True, False, False, True]
    assert [got[i].cons_08 for i in "125"] == [True, True, False]
    assert [got[i].fia_04 for i in "1245"] == [True, False, True, False]
    assert [got[i].fia_11 for i in "123"] == [True, False, True]
    assert got["1"].val_12 is None and got["1"].val_07 is None
    assert got["1"].fia_09 is False and got["1"].score_calidad == 93.3  # the lower of two awards is below their first percentile; 14 of 15
    half = spark.createDataFrame([tuple([True] * 9 + [False] * 7 + [None])], ", ".join(f"c{i} boolean" for i in range(17)))
    assert quality.with_score(half, half.columns).first().score_calidad == 56.2


def test_company_facts_and_boundaries(spark):
    import datetime as dt

    day = dt.datetime(2020, 6, 1)
    register = [("A", day, "Constitución", 5_000.0), ("B", day - dt.timedelta(181), "Constitución", 0.0), ("C", day + dt.timedelta(365), "Disolución", None), ("D", day + dt.timedelta(366), "Extinción", None), ("E", day, "Declaración de concurso", None), ("F", day + dt.timedelta(1), "Constitución", None)]
    awards = [(x, f"{x} SL", 200_000.0, day) for x in "ABCDEFG"]
    got = {r.id: r for r in companies.anomalies(spark.createDataFrame(awards, "id string, adjudicatario string, importe_adjudicacion double, fecha_adjudicacion timestamp"), spark.createDataFrame(register, "empresa_norm string, fecha_borme timestamp, actos string, capital_euros double")).collect()}
    assert [got[x].new_company for x in "ABFG"] == [True, False, False, False]
    assert [got[x].soon_dissolved for x in "CDG"] == [True, False, False]
    assert got["E"].insolvent_before and not got["A"].insolvent_before
    assert got["A"].low_capital and got["B"].amount_to_capital is None


def test_shared_officers_have_bounds(spark):
    rows = [(f"p{n}", f"c{i:02d}", "nombramiento") for n in (1, 2, 20, 21) for i in range(n)] + [(None, "c00", "nombramiento"), ("p2", "c01", "nombramiento"), ("p2", "c09", "cese")]
    got = companies.officer_graph(spark.createDataFrame(rows, "persona_hash string, empresa_norm string, tipo_acto string")).collect()
    assert len(got) == 190 and all(r.company_a < r.company_b for r in got)
    assert {(r.n_shared, r.shared) for r in got if (r.company_a, r.company_b) == ("c00", "c01")} == {(2, "p2,p20")}


def test_sessions(spark):
    rows = [(1, "a", 0), (2, "a", 7), (3, "a", 15), (4, "b", 0), (5, None, 1), (6, "a", None), (7, "a", 15)]
    got = {r.id: r.session for r in windows.sessions(spark.createDataFrame(rows, "id int, k string, at int"), "k", "at", 7).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 7: 2, 4: -1, 5: -1, 6: -1}


def test_reshape(spark):
    df = spark.createDataFrame([((1, ("x",)), [1, 2])], "a struct<b: int, c: struct<d: string>>, e array<int>")
    assert reshape.flatten(df).columns == ["a_b", "a_c_d", "e"]
    both = reshape.union_all([spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([("z", 2)], "id string, b int")])
    assert sorted(map(str, (tuple(r) for r in both.collect()))) == ["('1', 'x', None)", "('z', None, 2)"]
    twice = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "y", "x")
    assert reshape.unique_names(twice).columns == ["x", "y", "x_dup2"] and tuple(reshape.first_of_names(twice).first()) == (1, 2)
    assert reshape.without_empty_columns(spark.createDataFrame([(1, None)], "a int, b int")).columns == ["a"]
    notice = spark.createDataFrame([("n", ["1", "2", "3"], ["w", ""], ["10"], ["9", "8"])], "id string, lot array<string>, winner array<string>, tender array<string>, result array<string>")
    lots = reshape.lots(notice, "id", ["lot", "winner", "tender", "result"], {"value": ["tender", "result"]}).orderBy("lot_index").collect()
    assert [(r.lot, r.winner, r.value) for r in lots] == [("1", "w", "10"), ("2", None, "10"), ("3", None, "10")]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id;nombre\n1;Peña\n2\n3;x;y\n".encode())
    assert [tuple(r) for r in readers.delimited(spark, str(tmp_path / "a.csv")).collect()] == [("1", "Peña"), ("2", None)]
    (tmp_path / "b.csv").write_bytes("id§año\n1§Peña\n".encode("latin-1"))
    assert [tuple(r) for r in readers.delimited(spark, str(tmp_path / "b.csv")).collect()] == [("1", "Peña")]
    assert readers.sniff((tmp_path / "b.csv").read_bytes())[:2] == ("ISO-8859-1", "§")
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "1.csv").write_bytes("id;n\n1;Peña\n2;x;\n3;\"a;b\"\n".encode())
    (mixed / "2.csv").write_bytes("id,año\n4,2020\n".encode("latin-1"))
    (mixed / "3.csv").write_bytes(b"id;n\n5;y\n")
    (mixed / "4.csv").write_bytes(b"")
    got = readers.delimited(spark, str(mixed))
    assert sorted((r["id"], r["n"], r["año"]) for r in got.collect()) == [("1", "Peña", None), ("3", "a;b", None), ("4", None, "2020"), ("5", "y", None)]
    assert sorted(r["n"] for r in got.select("n").where("n is not null").collect()) == ["Peña", "a;b", "y"]
    (tmp_path / "p.json").write_text('{"items": [{"id": 1, "n": {"x": 2}}, {"id": 2}]}')
    assert readers.json_pages(spark, str(tmp_path / "p.json")).count() == 2
    for i, body in enumerate(['[{"a": 1}, {"a": 2}]', '{"data": [{"a": 3}]}', '{"k": {"a": 4}, "l": {"a": 5}}']):
        (tmp_path / f"v{i}.json").write_text(body)
    got = readers.json_any(spark, str(tmp_path / "v*.json")).select(F.try_variant_get("record", "$.a", "int").alias("a"))
    assert sorted(r.a for r in got.collect()) == [1, 2, 3, 4, 5]
    feed = "<feed><entry><id>1</id><p><i s='NIF'>A1</i><i s='NIF'>A2</i><i s='DIR3'>D</i></p></entry></feed>"
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("f.atom", feed)
        z.writestr("readme.txt", "x" * 200)
    (tmp_path / "bad.zip").write_bytes(b"PK\x03\x04" + b"0" * 200)
    assert [(r.member, r.content) for r in readers.archives(spark, str(tmp_path)).collect()] == [("f.atom", feed)]
    (tmp_path / "f.xml").write_text(feed.replace(" s=", " _schemeName=").replace("_schemeName", "schemeName"))
    entry = readers.xml_entries(spark, str(tmp_path / "f.xml"))
    assert entry.select(readers.party_id(F.col("p.i"), "NIF").alias("nif")).first().nif == "A2"
    chain = spark.createDataFrame([("C", "B", None, "A")], "a string, b string, c string, d string")
    assert chain.select(readers.parent_chain([F.col(c) for c in "abcd"]).alias("x")).first().x == "A > B > C"


def test_workbook_written_only_if_it_fits(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a<&\x01", None), (" b ", "2")], "x string, `y.z` string")
    assert sinks.workbook(df, str(tmp_path / "w.xlsx"))
    assert [r.cells for r in readers.workbooks(spark, str(tmp_path)).orderBy("row").collect()] == [["x", "y.z"], ["a<&", None], [" b ", "2"]]
    assert sinks.workbook(df.limit(0), str(tmp_path / "empty.xlsx"))
    monkeypatch.setattr(sinks, "SHEET_ROWS", 2)
    assert not sinks.workbook(df, str(tmp_path / "more.xlsx")) and not (tmp_path / "more.xlsx").exists()


def test_workbooks_and_pages(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>id</t></si><si><t>nombre</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>7</v></c><c r="C2" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "w.xlsx").write_bytes(book.getvalue())
    (tmp_path / "bad.xlsx").write_bytes(b"nothing")
    assert [r.cells for r in readers.workbooks(spark, str(tmp_path)).orderBy("row").collect()] == [["id", None, "nombre"], ["7", None, "x"]]
    html = "<dl><dt>Importe:</dt><dd>1.234,56 <b>€</b></dd><dt>Importe:</dt><dd>2</dd></dl><table><tr><th>CPV</th><th>Texto</th></tr><tr><td>1</td><td>a</td></tr><tr><td>2</td><td>b</td></tr></table>"
    page = readers.html_pages(spark.createDataFrame([(1, html), (2, None)], "id long, body string"), "id", "body")
    names = readers.labelled(F.col("pairs"), {"importe": "amount"}, text.label_key)
    got = page.select("id", names["amount"].alias("amount"), F.size(readers.table_rows(F.col("tables"), ["CPV", "Texto"])).alias("n")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "1.234,56 €", 2), (2, None, 0)]


GAZETTE = """BOLETÍN OFICIAL DEL REGISTRO MERCANTIL
Núm. 12 Lunes 3 de enero Pág. 7
SECCIÓN PRIMERA
12345 - EMPRESA UNO SL.
Constitución. Comienzo de operaciones: 1.01.20. Objeto social: COMERCIO. Domicilio: C/ MAYOR 1 (MADRID). Capital: 3.000,50 Euros.
Nombramientos. Adm. Unico: PEREZ LOPEZ ANA;GARCIA RUIZ LUIS. Apoderado: RUIZ PAZ EVA. Ceses/Dimisiones. Apoderado: SOLO GIL EVA. Datos registrales. T 1 , F
cve
12346 - GRUPO DOS Sociedad Limitada Laboral.
Cambio de domicilio social. C/ NUEVA 2. Datos registrales. T 41234, L 0, F 12, S 8, H M 567890, I/A 3 (5.01.20).
12347 - TRES SOCIEDAD ANONIMA. Fe de erratas: NADA.
12348 - CUATRO SA. Otros conceptos: UNA COSA. Revocaciones. Apo.Sol.: UNO DOS. Algo raro: TEXTO
"""


def test_gazette(spark):
    pages = spark.createDataFrame([("/x/2020/1/7/BORME-A-2020-4-28.pdf", GAZETTE), ("/x/other.pdf", GAZETTE)], "path string, body string")
    named = gazette.named(pages, "path")
    entries = gazette.entries(named, "path", "body").orderBy("entry_index")
    got = entries.collect()
    assert [(r.num_entrada, r.empresa, r.empresa_norm) for r in got] == [("12345", "EMPRESA UNO SL", "EMPRESA UNO"), ("12346", "GRUPO DOS Sociedad Limitada Laboral", "GRUPO DOS"), ("12347", "TRES SOCIEDAD ANONIMA", "TRES"), ("12348", "CUATRO SA", "CUATRO")]
    assert {(r.fecha_borme, r.num_borme, r.cod_provincia, r.tipo_borme) for r in got} == {("2020-01-07", 4, "28", "A")}
    one, two, three, _ = got
    assert (one.fecha_constitucion, one.objeto_social, one.domicilio, one.capital_euros) == ("1.01.20.", "COMERCIO", "C/ MAYOR 1 (MADRID)", 3000.5)
    assert one.actos == "Constitución|Ceses/Dimisiones|Nombramientos" and two.actos == "Cambio de domicilio|Cambio de domicilio social" and three.actos == "Fe de erratas"
    assert (two.domicilio, two.tomo, two.hoja_registral, two.inscripcion, two.fecha_inscripcion) == ("C/ NUEVA 2", "41234", "M 567890", "3", "5.01.20")
    people = gazette.officers(entries).collect()
    assert sorted((r.persona, r.cargo, r.tipo_acto) for r in people) == [("GARCIA RUIZ LUIS", "Adm. Unico", "nombramiento"), ("PEREZ LOPEZ ANA", "Adm. Unico", "nombramiento"), ("RUIZ PAZ EVA", "Apoderado", "nombramiento"), ("SOLO GIL EVA", "Apoderado", "cese"), ("UNO DOS", "Apo.Sol.", "revocacion")]
    report = {(r.measure, r.value): r.n for r in gazette.parser_report(entries).collect()}
    assert report["office", "Apoderado"] == 2 and report["kind", "cese"] == 1 and report["body", "Constitución"] == 1


def test_feed_from_archive_to_records(spark, tmp_path):
    entry = """<entry><id>https://x/1</id><link href="https://x/d?a=1&amp;b=2"/><updated>2026-03-25T10:00:00.000+01:00</updated><cac-place-ext:ContractFolderStatus>
    <cbc:ContractFolderID> T/1 </cbc:ContractFolderID><cbc-place-ext:ContractFolderStatusCode>RES</cbc-place-ext:ContractFolderStatusCode>
    <cac-place-ext:LocatedContractingParty><cac:Party><cac:PartyIdentification><cbc:ID schemeName="NIF">A1</cbc:ID></cac:PartyIdentification><cac:PartyIdentification><cbc:ID schemeName="DIR3">L01</cbc:ID></cac:PartyIdentification><cac:PartyIdentification><cbc:ID schemeName="NIF">A2</cbc:ID></cac:PartyIdentification><cac:PartyName><cbc:Name>Órgano</cbc:Name></cac:PartyName></cac:Party>
    <cac-place-ext:ParentLocatedParty><cac:PartyName><cbc:Name>C</cbc:Name></cac:PartyName><cac-place-ext:ParentLocatedParty><cac:PartyName><cbc:Name>A</cbc:Name></cac:PartyName></cac-place-ext:ParentLocatedParty></cac-place-ext:ParentLocatedParty></cac-place-ext:LocatedContractingParty>
    <cac:ProcurementProject><cbc:Name>Proyecto</cbc:Name><cbc:TypeCode>1</cbc:TypeCode><cac:BudgetAmount><cbc:EstimatedOverallContractAmount currencyID="EUR">7809917.35</cbc:EstimatedOverallContractAmount><cbc:TotalAmount currencyID="EUR">5670000.00</cbc:TotalAmount><cbc:TaxExclusiveAmount currencyID="EUR">4685950.41</cbc:TaxExclusiveAmount></cac:BudgetAmount>
    <cac:RequiredCommodityClassification><cbc:ItemClassificationCode>33000000</cbc:ItemClassificationCode></cac:RequiredCommodityClassification><cac:RequiredCommodityClassification><cbc:ItemClassificationCode>44</cbc:ItemClassificationCode></cac:RequiredCommodityClassification><cac:PlannedPeriod><cbc:DurationMeasure unitCode="MON">12</cbc:DurationMeasure></cac:PlannedPeriod></cac:ProcurementProject>
    <cac:TenderingTerms/><cac:TenderingProcess/><cac:TenderResult><cbc:AwardDate>2026-01-02</cbc:AwardDate><cbc:ReceivedTenderQuantity>3</cbc:ReceivedTenderQuantity><cbc:SMEAwardedIndicator>false</cbc:SMEAwardedIndicator><cac:WinningParty><cac:PartyIdentification><cbc:ID schemeName="NIF">B9</cbc:ID></cac:PartyIdentification><cac:PartyName><cbc:Name>Gana</cbc:Name></cac:PartyName></cac:WinningParty><cac:AwardedTenderedProject><cac:LegalMonetaryTotal><cbc:TaxExclusiveAmount>x</cbc:TaxExclusiveAmount><cbc:PayableAmount>12.5</cbc:PayableAmount></cac:LegalMonetaryTotal></cac:AwardedTenderedProject></cac:TenderResult><cac:TenderResult><cbc:AwardDate>2027-01-02</cbc:AwardDate></cac:TenderResult>
    <cac-place-ext:ValidNoticeInfo><cac-place-ext:AdditionalPublicationStatus><cac-place-ext:AdditionalPublicationDocumentReference><cbc:IssueDate>2026-03-25</cbc:IssueDate></cac-place-ext:AdditionalPublicationDocumentReference></cac-place-ext:AdditionalPublicationStatus></cac-place-ext:ValidNoticeInfo></cac-place-ext:ContractFolderStatus></entry>"""
    without = "<entry><id>2</id><cac-place-ext:ContractFolderStatus><cbc:ContractFolderID>T/2</cbc:ContractFolderID><cac:ProcurementProject><cbc:Name>sin</cbc:Name><cbc:TypeCode>77</cbc:TypeCode></cac:ProcurementProject></cac-place-ext:ContractFolderStatus></entry>"
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a/f.atom", f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{entry}{without}<entry><id>3</id></entry></feed>')
    got = {r.expediente: r.asDict() for r in feeds.contract_records(feeds.archived_entries(spark, str(tmp_path))).collect()}
    assert set(got) == {"T/1", "T/2"} and len(got["T/1"]) == 39 + 2
    wanted = dict(valor_estimado_contrato=7809917.35, importe_sin_iva=4685950.41, importe_con_iva=5670000.0, importe_adjudicacion=None, importe_adj_con_iva=12.5, nif_organo="A2", dir3_organo="L01", dependencia="A > C", organo_contratante="Órgano", tipo_contrato="Suministros", estado="Resuelta", cpv_principal="33000000", cpvs="33000000;44", duracion="12", duracion_unidad="MON", adjudicatario="Gana", nif_adjudicatario="B9", num_ofertas=3, es_pyme=False, fecha_adjudicacion="2026-01-02", fecha_publicacion="2026-03-25", url="https://x/d?a=1&b=2", fecha_updated="2026-03-25T10:00:00.000+01:00")
    assert {k: got["T/1"][k] for k in wanted} == wanted
    assert got["T/2"]["tipo_contrato"] == "77" and got["T/2"]["importe_sin_iva"] is got["T/2"]["valor_estimado_contrato"] is got["T/2"]["importe_con_iva"] is got["T/2"]["dependencia"] is None


def test_flat_documents(spark):
    document = {"idExpediente": 123, "numeroExpediente": "EXP-2026-001", "titulo": "Contrato", "tipoContrato": {"codigo": "SERV", "descripcion": "Servicios"}, "perfilContratante": {"codigo": "SYBS03", "descripcion": "Salud", "codigoDir3": "A01"}, "estado": {"codigo": "ADJ", "nombre": "Adjudicado"}, "importeLicitacion": 100.0, "fechaPublicacion": "2026-01-15T10:00:00+0100", "codigosCpv": ["33140000", "33190000"], "provinciasEjecucion": ["29", "41"]}
    document |= {"adjudicaciones": [{"nifAdjudicatario": "A12345678;", "importeAdjudicacion": 95.0}, {"nifAdjudicatario": "B87654321;"}], "anuncios": [{"fechaPublicacion": "2026-01-20T08:00:00+0100"}, {"fechaPublicacion": "2026-01-10T08:00:00+0100"}], "mediosPublicacion": [{"codigo": "DOUE"}, {"codigo": "PLACSP"}], "lotes": [1, 2]}
    rows = spark.createDataFrame([(json.dumps(document),), ('{"tipoContrato": "otro", "perfilContratante": null}',)], "doc string")
    one, two = feeds.flat_documents(rows, "doc", "https://x").collect()
    wanted = dict(id_expediente="123", tipo_contrato="Servicios", tipo_contrato_codigo="SERV", codigo_perfil="SYBS03", adjudicatario_nif="A12345678", todos_adjudicatarios_nif="A12345678;B87654321", cpv="33140000;33190000", provincias_ejecucion="29;41", num_adjudicaciones=2, num_anuncios=2, num_lotes=2, medios_publicacion="DOUE;PLACSP", anuncio_primera_fecha="2026-01-10", anuncio_ultima_fecha="2026-01-20", fecha_publicacion="2026-01-15")
    assert len(one) == 34 and {k: one[k] for k in wanted} == wanted and one.url_detalle.endswith("idExpediente=123")
    assert two.tipo_contrato == "otro" and two.codigo_perfil == two.cpv == two.fecha_publicacion == "" and two.num_lotes == 0


def test_detail_pages(spark):
    cells = lambda tag, row: "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in row) + "</tr>"
    table = lambda head, *rows: "<table>" + cells("th", head) + "".join(cells("td", r) for r in rows) + "</table>"
    pairs = [("Referencia", "REF-1"), ("Tipo de tramitación", "Ordinaria"), ("Orzamento base de licitación", "1.234,56 €"), ("Valor estimado", "2.345,67 €"), ("Nº lotes", "2"), ("Fecha de difusión en la Plataforma de Contratos:", "23/03/2026"), ("Fecha formalización:", "24/03/2026"), ("Compra pública estratéxica:", "Sí"), ("Referencia", "later")]
    html = "<title>Detalle procedemento: 8 -  Galicia</title><dl>" + "".join(f"<dt>{a}</dt><dd>{b}</dd>" for a, b in pairs) + "</dl>"
    html += table(["Perfil", "BOP", "DOG", "BOE", "Fecha envío DOUE"], ["Perfil", "", "", "", "23/03/2026"]) + table(["código CPV", "Lote"], ["12345678", "1"], ["87654321", "2"]) + table(["NUT", "Lote"], ["ES111", "1"])
    html += table(["Título", "Fecha", "Estado", "Descarga"], ["Pliego", "a", "b", "c"], ["Anuncio", "a", "b", "c"])
    got = feeds.detail_records(spark.createDataFrame([(1, html), (2, "<title>Error</title>")], "id long, html string"), "id", "html").collect()
    wanted = dict(referencia="REF-1", tipo_tramitacion="Ordinaria", presupuesto_base_eur=1234.56, valor_estimado_eur=2345.67, num_lotes=2.0, cpv_codes="12345678, 87654321", nuts_codes="ES111", documentos_count=2, publicaciones_count=1, adjudicaciones_count=None, fecha_difusion="2026-03-23T00:00:00", fecha_formalizacion="2026-03-24T00:00:00", compra_publica_estrategica="Sí")
    assert len(got) == 1 and {k: got[0][f"detail_{k}"] for k in wanted} == wanted


def test_notice_lots(spark):
    names = "winner_names winner_ids winner_countries winner_sizes winner_dates tender_values result_values estimated_values offers lot_ids result_lot_ids".split()
    rows = [("n", "can-standard", ["w", "v"], ["1", "2", "3"], ["ES"], ["small"], ["d"], ["10", ""], ["7", "8"], ["5", "6", "4"], ["9"], [], ["L1"]), ("c", "cn-standard", ["w", "v"], None, [], [], [], [], [], [], [], [], [])]
    got = feeds.notice_lots(spark.createDataFrame(rows, "id string, notice_type string, " + ", ".join(f"{n} array<string>" for n in names)), ["id"]).orderBy("id", "lot_index").collect()
    assert [(r.id, r.lot_index, r.value, r.win_name, r.win_nationalid, r.win_country, r.win_size, r.lot_id) for r in got] == [("c", 0, "", "w", "", "", "", ""), ("n", 0, "10", "w", "1", "ES", "small", "L1"), ("n", 1, "8", "v", "2", "", "small", ""), ("n", 2, "4", "v", "3", "", "small", "")]


def test_layouts():
    assert layouts.header_row([["Contratos 2020", "", ""], ["Nº exp", "Objeto", "Importe"], ["1", "a", "2"]]) == 1
    assert layouts.detect(["NIF ", "Objeto_contrato", "Importe"], {"A": ["nif", "importe"], "B": ["nif", "objeto contrato", "importe"], "C": ["x"]}) == "B"
    taken = layouts.direct(["N.I.F.", "OBJETO DEL CONTRATO"], {"objeto del contrato": "objeto"})
    assert taken == {"OBJETO DEL CONTRATO": "objeto"}
    assert layouts.by_keywords(["Importe IVA incluido", "Importe"], {"con_iva": [("importe", "iva")], "sin_iva": [("importe",)]}, {}) == {"Importe IVA incluido": "con_iva", "Importe": "sin_iva"}
    assert layouts.by_order(["importe adjudicación sin iva", "importe"], [("adjudicaci.n.*sin", "adj"), ("importe", "total")], {}) == {"importe adjudicación sin iva": "adj", "importe": "total"}
    assert layouts.positional(["01/02/2020", "x"], [(r"^\d{2}/", ["fecha", "objeto"]), ("", ["tipo", "fecha"])]) == ["fecha", "objeto"]


def test_state_and_sinks(spark, tmp_path):
    state = spark.createDataFrame([("1", "done", 1, 0), ("2", "retryable", 2, 0), ("3", "failed", 4, 0)], "id string, status string, attempts int, t int")
    items = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    ids = lambda **k: sorted(r.id for r in incremental.to_do(items, state, ["id"], **k).collect())
    assert ids() == ["2", "4"] and ids(retryable_only=True) == ["2"] and ids(ignore_most=True) == ["2", "3", "4"] and ids(force=True) == ["1", "2", "3", "4"]
    batch = spark.createDataFrame([("2", "done", 5), ("9", "done", 1), ("9", "failed", 2)], "id string, status string, t int")
    after = {r.id: r.status for r in sinks.upsert(state, batch, ["id"], "t").collect()}
    assert after == {"1": "done", "2": "done", "3": "failed", "9": "failed"}
    assert {r.id: r.attempts for r in incremental.attempts(state.select("id", "status", "attempts"), batch.where("t != 2").select("id", "status"), ["id"]).collect()}["2"] == 3
    sinks.parquet(after_frame := sinks.upsert(state, batch, ["id"], "t"), str(tmp_path / "out"), by=["status"], drop_empty=True)
    assert readers.parquet(spark, str(tmp_path / "out"), columns=["id", "none"]).columns == ["id"]
    sinks.delimited(after_frame, str(tmp_path / "csv"))
    assert sinks.manifest(spark, str(tmp_path / "csv")).where("path like '%.csv'").count() >= 1
    assert {r.column: r.n_values for r in sinks.summary(state).collect()}["id"] == 3


def test_incremental_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "state")
    for n, rows in enumerate(([(1, "a", 1), (2, "b", 1)], [(2, "c", 2), (3, "d", 2)])):
        spark.createDataFrame(rows, "id int, v string, t int").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.new_files(spark, source, spark.read.parquet(source).schema)
        incremental.run_once(stream, str(tmp_path / "mark"), incremental.upsert_into(target, ["id"], "t"))
        got = {r.id: r.v for r in spark.read.parquet(f"{target}/v={n}").collect()}
    assert got == {1: "a", 2: "c", 3: "d"}


@pytest.mark.parametrize("n", [5])
def test_sample_is_stable(spark, n):
    df = spark.range(100)
    assert readers.sample(df, n).collect() == readers.sample(df, n).collect()
