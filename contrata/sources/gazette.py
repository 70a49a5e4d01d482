"""Gazette text as entries, acts and officers (P8-P10), as expressions over whole texts; and the parser's report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.functions import text, values

#: Lines that belong to the page and not to its entries.
NOISE = [r"BOLETÍN OFICIAL DEL REGISTRO.*", r"Núm\..*Pág\..*", r"[\d-]+[A-Z]-EMROB", r":evc", r"http://www\.boe\.es.*", r".*D\.L\.: M-5188.*", "SECCIÓN PRIMERA", "Empresarios", "Actos inscritos", "SECCIÓN SEGUNDA", "Anuncios y avisos legales", "Otros actos publicados en el Registro Mercantil"]
#: Words of legal forms, which are mixed case in company names.
FORM_WORDS = ["Sociedad", "Limitada", "Anónima", "Anonima", "Cooperativa", "Profesional", "Laboral", "Deportiva", "Unipersonal", "Civil", "Comanditaria", "Colectiva", "Comandita", "Agrupación", "Agrupacion", "Europea", "Responsabilidad", "Sucursal", "Nueva", "Empresa"]
#: Acts, in the order in which they are told.
ACTS = [
    "Constitución", "Disolución", "Extinción", "Ceses/Dimisiones", "Nombramientos", "Revocaciones", "Reelecciones", "Cancelaciones de oficio de nombramientos", "Nombramiento de administradores",
    "Modificaciones estatutarias", "Cambio de domicilio social", "Cambio de objeto social", "Cambio de denominación social", "Ampliación del objeto social", "Ampliacion del objeto social", "Ampliación de capital", "Reducción de capital",
    "Fusión por absorción", "Fusión", "Escisión", "Transformación de sociedad", "Transformación", "Situación concursal", "Auto de declaración de concurso", "Auto de apertura de la fase de liquidación", "Auto de conclusión del concurso",
    "Revocación de administradores concursales", "Crédito incobrable", "Cierre provisional hoja registral", "Reapertura hoja registral", "Declaración de unipersonalidad", "Pérdida del carácter de unipersonalidad", "Pérdida del caracter de unipersonalidad",
    "Otros conceptos", "Fe de erratas", "Depósito de cuentas anuales", "Empresario Individual", "Sociedad unipersonal",
]
#: Sections that officers stand under.
SECTIONS = {"Nombramientos": "nombramiento", "Ceses/Dimisiones": "cese", "Revocaciones": "revocacion", "Reelecciones": "reeleccion", "Cancelaciones de oficio de nombramientos": "cancelacion"}
#: What looks like an office and is none.
NO_OFFICES = ["Objeto social", "Domicilio", "Capital", "Datos registrales", "ACTIVIDAD PRINCIPAL", "Comienzo de operaciones", "Artículo de los estatutos", "ARTICULO", "Otros conceptos", "Sociedades absorbidas", "Resoluciones", "Denominación y forma adoptada"]
NO_OFFICE = r"(?i)^(?:ART(?:ICULO|S)?[\s.\d,]+|CNAE\s|ACTIVIDAD)"
NAMES = r":\s*([A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ\d\s;,.\-]+?)(?:\.\s|$)"
OFFICE = r"(?<=\.\s)([A-Z][A-Za-záéíóúñ.\s/\-\d=]{0,25}?)" + NAMES
#: An office with its names, or a section's name outside of one. No office begins inside a section's name.
OFFICE_OR_SECTION = "(?=[A-Z])(?:" + OFFICE + "|" + "|".join(SECTIONS) + ")"
REGISTRY = r"Datos registrales[.:]\s*T\s*(\d+),\s*L\s*(\d+),\s*F\s*(\d+),\s*S\s*(\d+),\s*H\s*([A-Z\s]*\d+),\s*I/A\s*(\d+)\s*\((\d{1,2}\.\d{2}\.\d{2,4})\)"


def _strip(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\n\x0b\f\r"))


def _found(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, which is computed once however often f speaks of it."""
    return F.transform(F.array(x), f)[0]


def named(pages: DataFrame, path: str) -> DataFrame:
    """Gazettes with what their file name and folder tell: tipo_borme, num_borme, cod_provincia, pdf_filename and fecha_borme; others are left out."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    pattern = r"^BORME-([A-Z])-(\d{4})-(\d+)-(\d+)"
    part = lambda i: F.regexp_extract(name, pattern, i)
    folders = r"/(20[0-2]\d|2030)/(\d{1,2})/(\d{1,2})(?:/|$)"
    dated = lambda i: F.lpad(F.regexp_extract(path, folders, i), 2, "0")
    date = F.when(F.col(path).rlike(folders), F.concat_ws("-", F.regexp_extract(path, folders, 1), dated(2), dated(3))).otherwise(F.concat(part(2), F.lit("-01-01")))
    return pages.where(name.rlike(pattern)).withColumns({"pdf_filename": name, "tipo_borme": part(1), "num_borme": part(3).cast("int"), "cod_provincia": part(4), "fecha_borme": date})


def entries(pages: DataFrame, key: str, body: str) -> DataFrame:
    """A row for each numbered entry: num_entrada, empresa, empresa_norm, cuerpo and what the body tells. An entry lasts until the next number; the company's name ends where a sentence begins with a mixed-case word that is no legal form."""
    lines = F.filter(F.split(F.coalesce(F.col(body), F.lit("")), "\n"), lambda x: ~_strip(x).rlike("^(?:" + "|".join(NOISE) + ")$"))
    header = r"^\d{4,7}\s*-\s*"
    blocks = F.filter(F.split(F.array_join(lines, "\n"), r"(?m)^(?=\d{4,7}\s*-)"), lambda e: e.rlike(header))
    rows = pages.select(*[F.col(c) for c in pages.columns if c != body], F.posexplode(blocks).alias("entry_index", "__e"))
    block = _strip(F.regexp_replace(F.regexp_replace("__e", header, ""), r"\s{2,}|[^\S ]", " "))
    rows = rows.withColumns({"num_entrada": F.regexp_extract("__e", r"^(\d{4,7})", 1), "__b": block})
    begins = r"(?:\s+(?!(?:" + "|".join(FORM_WORDS) + r")[.:\s])(?=[A-ZÁÉÍÓÚÑ][a-záéíóúñ]{2,})|\s+(?=Fe de erratas))"
    rows = rows.withColumn("__c", F.regexp_extract("__b", r"(?s)^(.*?\.)" + begins, 1))
    company = F.col("__c")
    whole = F.when(company != "", company).otherwise(F.col("__b"))
    rows = rows.withColumns({"empresa": F.regexp_replace(_strip(whole), r"\.+$", ""), "cuerpo": F.when(company != "", F.concat(F.lit(". "), _strip(F.substring(F.col("__b"), F.length(company) + 1, F.length("__b"))))).otherwise("")})
    return _with_body(rows.drop("__e", "__b", "__c").withColumn("empresa_norm", text.company_key_once(F.col("empresa"))))


def _with_body(rows: DataFrame) -> DataFrame:
    said = F.col("cuerpo")
    has = lambda act: said.contains(f"{act}.") | said.contains(f"{act}:")
    founded = has("Constitución")
    seat, moved = _found(said, r"(?s)Domicilio[.:]\s*(.+?)(?:[.]\s*Capital[.:]|$)"), said.contains("Cambio de domicilio social.")
    new_seat = _found(said, r"Cambio de domicilio social[.:]\s*(.+?)(?:[.]\s*Datos registrales|$)")
    acts = [F.when(founded, "Constitución"), F.when(seat.isNull() & moved, "Cambio de domicilio"), *[F.when(has(a), a) for a in ACTS[1:]]]
    registry = lambda i: _found(said, REGISTRY, i)
    return rows.withColumns(
        {
            "fecha_constitucion": F.when(founded, _found(said, r"Comienzo de operaciones[.:]\s*([\d.]+)")),
            "objeto_social": F.when(founded, F.substring(_strip(_found(said, r"(?s)Objeto social[.:]\s*(.+?)(?:[.]\s*Domicilio[.:]|$)")), 1, 500)),
            "domicilio": F.substring(_strip(F.coalesce(seat, F.when(moved, new_seat))), 1, 300),
            "capital_euros": values.number(F.replace(F.replace(_found(said, r"Capital[.:]\s*([\d.,]+)\s*Euros"), F.lit("."), F.lit("")), F.lit(","), F.lit("."))),
            "actos": F.array_join(F.array_compact(F.array(*acts)), "|"),
            "tomo": registry(1),
            "hoja_registral": _strip(registry(5)),
            "inscripcion": registry(6),
            "fecha_inscripcion": registry(7),
        }
    )


def _people(body: Column) -> Column:
    """The officers that a text names, as an array of (cargo, tipo_acto, persona)."""
    section = "(" + "|".join(SECTIONS) + ")"
    is_office = lambda x: x.contains(":")
    label = lambda x: F.substring_index(x, ":", 1)

    def told(x: Column) -> Column:
        within = F.regexp_extract_all(label(x), F.lit(section), F.lit(0))
        return F.when(~is_office(x), x).when(F.size(within) > 0, F.element_at(within, -1))

    def with_sections(s: Column) -> Column:
        # each office with the section told last before it, be it in another office: by runs, as an array that grows by each copies itself
        ends = F.filter(F.transform(s["told"], lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())
        run = lambda r: F.filter(F.slice(s["found"], r["after"] + 2, r["to"] - r["after"]), is_office)
        runs = F.arrays_zip(F.concat(F.array(F.lit(-1)), ends).alias("after"), F.concat(ends, F.array(F.size(s["found"]) - 1)).alias("to"))
        held = lambda r: F.when(r["after"] < 0, "").otherwise(F.get(s["told"], r["after"]))
        return F.flatten(F.transform(runs, lambda r: F.transform(run(r), lambda x: F.struct(x.alias("all"), held(r).alias("section")))))

    found = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(OFFICE_OR_SECTION), F.lit(0))
    found = _bound(found, lambda x: F.struct(x.alias("found"), F.transform(x, told).alias("told")))
    found = _bound(found, with_sections)
    # in steps, so that each pattern runs once
    found = F.transform(found, lambda o: F.struct(_strip(label(o["all"])).alias("raw"), _strip(F.regexp_extract(o["all"], "^[^:]*" + NAMES, 1)).alias("names"), o["section"].alias("section")))
    found = F.transform(found, lambda o: F.struct(o["raw"].alias("raw"), F.regexp_extract(o["raw"], "^" + section + r"\.", 1).alias("own"), o["names"].alias("names"), o["section"].alias("section")))

    def office(o: Column) -> Column:
        rest = F.ltrim(_strip(F.substring(o["raw"], F.length(o["own"]) + 1, F.length(o["raw"]))), F.lit(". "))
        own, kind = F.when(o["own"] != "", o["own"]).otherwise(o["section"]), F.lit("nombramiento")
        for name, value in SECTIONS.items():
            kind = F.when(own == name, value).otherwise(kind)
        return F.struct(o["raw"].alias("raw"), _strip(F.when(o["own"] != "", rest).otherwise(o["raw"])).alias("cargo"), kind.alias("tipo_acto"), o["names"].alias("names"))

    none = lambda x: x.isin(NO_OFFICES) | x.rlike(NO_OFFICE)
    words = lambda x: F.size(F.regexp_extract_all(x, F.lit(r"[^\s;.]{2,}"), F.lit(0)))
    found = F.filter(F.transform(found, office), lambda o: (o["cargo"] != "") & ~none(o["raw"]) & ~none(o["cargo"]) & (words(o["names"]) >= 2))
    people = lambda names: F.filter(F.transform(F.split(names, ";"), _strip), lambda p: p != "")
    return F.flatten(F.transform(found, lambda o: F.transform(people(o["names"]), lambda p: F.struct(o["cargo"].alias("cargo"), o["tipo_acto"].alias("tipo_acto"), p.alias("persona")))))


def officers(rows: DataFrame, body: str = "cuerpo") -> DataFrame:
    """A row for each person of `Office: NAME; NAME`, with the section that stands in the office or nearest before it, `nombramiento` without one."""
    return rows.select("*", F.inline(_people(F.col(body))))


def parser_report(rows: DataFrame) -> DataFrame:
    """What the parser found: entries by the word that their body begins with, long company names, officers by office and by kind, and labels that look like an office and weren't taken as one. (measure, value, n)."""
    said = F.coalesce(F.col("cuerpo"), F.lit(""))
    told = lambda measure, value: F.struct(F.lit(measure).alias("measure"), value.alias("value"))
    begins = _strip(F.regexp_extract(said, r"^\. ([^.: ]*)", 1))
    maybe = F.regexp_extract_all(said, F.lit(r"(?<=\.\s)([^:]{1,30}?):\s*[A-ZÁÉÍÓÚÑ]{2,}"), F.lit(0))
    label = lambda m: _strip(F.substring_index(m, ":", 1))
    missed = F.filter(maybe, lambda m: ~label(m).isin(NO_OFFICES) & ~F.concat(F.lit(". "), m, F.lit(". ")).rlike(OFFICE))
    # one array an entry: branches of a union would each parse it
    found = F.concat(
        F.array_compact(F.array(F.when(F.length(said) > 2, told("body", begins)), F.when(F.length("empresa") > 150, told("long_name", F.substring("empresa", 1, 200))))),
        F.flatten(F.transform(_people(said), lambda p: F.array(told("office", p["cargo"]), told("kind", p["tipo_acto"])))),
        F.transform(missed, lambda m: told("missed", F.substring(label(m), 1, 50))),
    )
    return rows.select(F.inline(found)).groupBy("measure", "value").agg(F.count("*").alias("n"))
