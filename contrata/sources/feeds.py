"""Records out of nested documents: feed entries, portal documents, notices with lots and detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrata.functions import text, values
from contrata.sources import readers

#: Code lists of the feed.
CONTRACT_TYPES = {"1": "Suministros", "2": "Servicios", "3": "Obras", "21": "Gestión Servicios Públicos", "31": "Concesión Obras", "40": "Concesión Servicios", "7": "Administrativo Especial", "8": "Privado", "50": "Patrimonial", "22": "22"}
STATES = {"PUB": "Publicada", "EV": "En evaluación", "ADJ": "Adjudicada", "RES": "Resuelta", "ANUL": "Anulada", "DES": "Desierta"}
PROCEDURES = {"1": "Abierto", "2": "Restringido", "3": "Negociado con publicidad", "4": "Negociado sin publicidad", "5": "Diálogo competitivo", "6": "Asociación innovación", "100": "Basado en acuerdo marco", "999": "Otros"}
#: Levels of parent organisations that are read.
PARENTS = 16

_PARTY = "array<struct<`cbc:Name`:string>>"
_TEXT = "struct<_VALUE:string,_schemeName:string>"


def _parents(depth: int) -> str:
    inner = f",`cac-place-ext:ParentLocatedParty`:array<{_parents(depth - 1)}>" if depth > 1 else ""
    return f"struct<`cac:PartyName`:{_PARTY}{inner}>"


#: An entry, as far as it is read. Elements that may come again are arrays, of which the first one counts.
ENTRY = (
    "id string, updated string, link array<struct<_href:string>>, `cac-place-ext:ContractFolderStatus` struct<"
    "`cbc:ContractFolderID`:string,`cbc-place-ext:ContractFolderStatusCode`:string,"
    f"`cac-place-ext:LocatedContractingParty`:struct<`cac:Party`:struct<`cac:PartyName`:{_PARTY},`cac:PostalAddress`:array<struct<`cbc:CityName`:string>>,`cac:PartyIdentification`:array<struct<`cbc:ID`:{_TEXT}>>>,`cac-place-ext:ParentLocatedParty`:array<{_parents(PARENTS)}>>,"
    "`cac:ProcurementProject`:array<struct<`cbc:Name`:string,`cbc:TypeCode`:string,`cbc:SubTypeCode`:string,"
    "`cac:BudgetAmount`:array<struct<`cbc:EstimatedOverallContractAmount`:string,`cbc:TotalAmount`:string,`cbc:TaxExclusiveAmount`:string>>,"
    "`cac:RequiredCommodityClassification`:array<struct<`cbc:ItemClassificationCode`:string>>,`cac:RealizedLocation`:array<struct<`cbc:CountrySubentity`:string,`cbc:CountrySubentityCode`:string>>,"
    "`cac:PlannedPeriod`:array<struct<`cbc:DurationMeasure`:struct<_VALUE:string,_unitCode:string>>>>>,"
    "`cac:TenderingProcess`:array<struct<`cbc:ProcedureCode`:string,`cbc:UrgencyCode`:string,`cac:TenderSubmissionDeadlinePeriod`:array<struct<`cbc:EndDate`:string,`cbc:EndTime`:string>>>>,"
    "`cac:TenderingTerms`:array<struct<`cbc:FundingProgramCode`:string>>,"
    "`cac:TenderResult`:array<struct<`cbc:AwardDate`:string,`cbc:ReceivedTenderQuantity`:string,`cbc:SMEAwardedIndicator`:string,"
    f"`cac:WinningParty`:array<struct<`cac:PartyName`:{_PARTY},`cac:PartyIdentification`:array<struct<`cbc:ID`:{_TEXT}>>>>,"
    "`cac:AwardedTenderedProject`:array<struct<`cac:LegalMonetaryTotal`:array<struct<`cbc:TaxExclusiveAmount`:string,`cbc:PayableAmount`:string>>>>>>,"
    "`cac-place-ext:ValidNoticeInfo`:array<struct<`cac-place-ext:AdditionalPublicationStatus`:array<struct<`cac-place-ext:AdditionalPublicationDocumentReference`:array<struct<`cbc:IssueDate`:string>>>>>>>"
)


def entries(files: DataFrame, content: str = "content") -> DataFrame:
    """A row for each entry of the feeds in a column of text: the files' other columns and `entry`."""
    found = F.regexp_extract_all(F.col(content), F.lit(r"(?s)<entry[\s>].*?</entry>"), F.lit(0))
    return files.select(*[c for c in files.columns if c != content], F.explode(found).alias("entry"))


def archived_entries(spark, path: str) -> DataFrame:
    """Archive, member and entry of the feeds in all ZIP archives under a folder."""
    return entries(readers.archives(spark, path, r"\.atom$"))


def _first(column: Column, *path: str) -> Column:
    """The first value at the end of a path of arrays and fields, trimmed; null without one."""
    def field(name: str):
        return lambda x: x[name]

    found = column
    for name in path[:-1]:
        found = F.flatten(F.transform(found, field(name)))
    return F.get(F.filter(F.transform(found, lambda x: F.nullif(F.trim(x[path[-1]]), F.lit(""))), lambda x: x.isNotNull()), F.lit(0))


def _label(code: Column, labels: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), code), code)


def contract_records(rows: DataFrame, entry: str = "entry") -> DataFrame:
    """The contract's 39 fields of each entry (XML text), beside the other columns; entries without a contract are left out. What is no number is null."""
    parsed = rows.withColumn("__e", F.from_xml(F.col(entry), ENTRY)).where("__e.`cac-place-ext:ContractFolderStatus` is not null")
    top = F.col("__e")
    status = top["cac-place-ext:ContractFolderStatus"]
    located = status["cac-place-ext:LocatedContractingParty"]
    party, project = located["cac:Party"], F.slice(status["cac:ProcurementProject"], 1, 1)
    process, terms, result = (F.slice(status[c], 1, 1) for c in ("cac:TenderingProcess", "cac:TenderingTerms", "cac:TenderResult"))
    ids = F.filter(F.transform(party["cac:PartyIdentification"], lambda i: F.struct(F.trim(i["cbc:ID"]["_VALUE"]).alias("_VALUE"), i["cbc:ID"]["_schemeName"].alias("_schemeName"))), lambda i: i["_VALUE"] != "")
    levels, level = [], located["cac-place-ext:ParentLocatedParty"]
    for _ in range(PARENTS):
        parent = F.get(level, F.lit(0))
        levels.append(_first(parent["cac:PartyName"], "cbc:Name"))
        level = parent["cac-place-ext:ParentLocatedParty"] if len(levels) < PARENTS else None
    plain = lambda x: F.nullif(F.trim(x), F.lit(""))
    code = {"tipo": _first(project, "cbc:TypeCode"), "proc": _first(process, "cbc:ProcedureCode"), "estado": plain(status["cbc-place-ext:ContractFolderStatusCode"])}
    budget, total = F.flatten(F.transform(project, lambda p: p["cac:BudgetAmount"])), ("cac:AwardedTenderedProject", "cac:LegalMonetaryTotal")
    cpvs = F.filter(F.transform(F.flatten(F.transform(project, lambda p: p["cac:RequiredCommodityClassification"])), lambda c: plain(c["cbc:ItemClassificationCode"])), lambda c: c.isNotNull())
    offers, sme = _first(result, "cbc:ReceivedTenderQuantity"), _first(result, "cbc:SMEAwardedIndicator")
    chain = readers.parent_chain(levels)
    fields = {
        "id": plain(top["id"]),
        "expediente": plain(status["cbc:ContractFolderID"]),
        "objeto": _first(project, "cbc:Name"),
        "organo_contratante": _first(party["cac:PartyName"], "cbc:Name"),
        "nif_organo": readers.party_id(ids, "NIF"),
        "dir3_organo": readers.party_id(ids, "DIR3"),
        "id_plataforma": readers.party_id(ids, "ID_PLATAFORMA"),
        "ciudad_organo": _first(party["cac:PostalAddress"], "cbc:CityName"),
        "dependencia": F.nullif(chain, F.lit("")),
        "tipo_contrato_code": code["tipo"],
        "tipo_contrato": _label(code["tipo"], CONTRACT_TYPES),
        "subtipo_code": _first(project, "cbc:SubTypeCode"),
        "procedimiento_code": code["proc"],
        "procedimiento": _label(code["proc"], PROCEDURES),
        "estado_code": code["estado"],
        "estado": _label(code["estado"], STATES),
        "valor_estimado_contrato": values.number(_first(budget, "cbc:EstimatedOverallContractAmount")),
        "importe_sin_iva": values.number(_first(budget, "cbc:TaxExclusiveAmount")),
        "importe_con_iva": values.number(_first(budget, "cbc:TotalAmount")),
        "importe_adjudicacion": values.number(_first(result, *total, "cbc:TaxExclusiveAmount")),
        "importe_adj_con_iva": values.number(_first(result, *total, "cbc:PayableAmount")),
        "adjudicatario": _first(result, "cac:WinningParty", "cac:PartyName", "cbc:Name"),
        "nif_adjudicatario": F.nullif(F.trim(F.get(F.flatten(F.transform(F.flatten(F.transform(result, lambda r: r["cac:WinningParty"])), lambda p: p["cac:PartyIdentification"])), F.lit(0))["cbc:ID"]["_VALUE"]), F.lit("")),
        "num_ofertas": F.when(offers.rlike("^[-+]?[0-9]+$"), offers.try_cast("long")),
        "es_pyme": F.when(sme.isNotNull(), sme == "true"),
        "cpv_principal": F.get(cpvs, F.lit(0)),
        "cpvs": F.nullif(F.array_join(cpvs, ";"), F.lit("")),
        "ubicacion": _first(project, "cac:RealizedLocation", "cbc:CountrySubentity"),
        "nuts": _first(project, "cac:RealizedLocation", "cbc:CountrySubentityCode"),
        "duracion": _first(F.flatten(F.transform(project, lambda p: F.transform(p["cac:PlannedPeriod"], lambda x: x["cbc:DurationMeasure"]))), "_VALUE"),
        "duracion_unidad": _first(F.flatten(F.transform(project, lambda p: F.transform(p["cac:PlannedPeriod"], lambda x: x["cbc:DurationMeasure"]))), "_unitCode"),
        "financiacion_ue": _first(terms, "cbc:FundingProgramCode"),
        "urgencia": _first(process, "cbc:UrgencyCode"),
        "fecha_limite": _first(process, "cac:TenderSubmissionDeadlinePeriod", "cbc:EndDate"),
        "hora_limite": _first(process, "cac:TenderSubmissionDeadlinePeriod", "cbc:EndTime"),
        "fecha_adjudicacion": _first(result, "cbc:AwardDate"),
        "fecha_publicacion": _first(status["cac-place-ext:ValidNoticeInfo"], "cac-place-ext:AdditionalPublicationStatus", "cac-place-ext:AdditionalPublicationDocumentReference", "cbc:IssueDate"),
        "fecha_updated": plain(top["updated"]),
        "url": F.get(top["link"], F.lit(0))["_href"],
    }
    kept = [c for c in rows.columns if c != entry and c not in fields]
    return parsed.select(*kept, *[c.alias(name) for name, c in fields.items()])


#: Columns of a portal's document, and where each is.
DOCUMENT = {
    "id_expediente": "$.idExpediente", "numero_expediente": "$.numeroExpediente", "titulo": "$.titulo", "tipo_contrato": "$.tipoContrato.descripcion", "tipo_contrato_codigo": "$.tipoContrato.codigo", "organo_contratacion": "$.perfilContratante.descripcion", "codigo_perfil": "$.perfilContratante.codigo", "codigo_dir3": "$.perfilContratante.codigoDir3",
    "estado": "$.estado.nombre", "estado_codigo": "$.estado.codigo", "importe_licitacion": "$.importeLicitacion", "valor_estimado": "$.valorEstimado", "importe_adjudicacion": "$.adjudicaciones[0].importeAdjudicacion", "importe_adjudicacion_iva": "$.adjudicaciones[0].importeAdjudicacionConIva", "fecha_publicacion": "$.fechaPublicacion", "fecha_limite_presentacion": "$.fechaLimitePresentacion",
    "anuncio_primera_fecha": "", "anuncio_ultima_fecha": "", "adjudicatario_nif": "$.adjudicaciones[0].nifAdjudicatario", "todos_adjudicatarios_nif": "", "num_adjudicaciones": "", "codigo_procedimiento": "$.codigoProcedimiento", "codigo_tramitacion": "$.codigoTipoTramitacion", "codigo_normativa": "$.codigoNormativa", "forma_presentacion": "$.formaPresentacion", "cofinanciado_ue": "$.cofinanciadoUE",
    "subasta_electronica": "$.subastaElectronica", "sistema_racionalizacion": "$.sistemaRacionalizacion", "cpv": "", "provincias_ejecucion": "", "medios_publicacion": "", "num_lotes": "", "num_anuncios": "", "url_detalle": "",
}
DETAIL = "/perfiles-licitaciones/detalle-licitacion?idExpediente="


def flat_documents(rows: DataFrame, document: str, base: str = "") -> DataFrame:
    """The 34 columns of each document (JSON text): fields of its objects, the first award, joined lists, first and last dates, and sizes. All are text but the sizes; what isn't there is empty."""
    v = F.try_parse_json(F.col(document))
    at = lambda path: F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))
    items = lambda path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.expr("cast(array() as array<variant>)"))
    of = lambda path, field: F.transform(items(path), lambda x: F.try_variant_get(x, field, "string"))
    bare = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), ";+$", "")
    scalar = F.try_variant_get(v, "$.tipoContrato", "string")
    dates = F.filter(of("$.anuncios", "$.fechaPublicacion"), lambda d: F.length(d) > 0)
    awards = of("$.adjudicaciones", "$.nifAdjudicatario")
    out = {name: at(path) for name, path in DOCUMENT.items() if path}
    object_type = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.tipoContrato", "variant")).startswith("OBJECT"), F.lit(False))
    out["tipo_contrato"] = F.when(object_type, out["tipo_contrato"]).otherwise(F.coalesce(scalar, F.lit("")))
    out |= {name: values.day_prefix(out[name]) for name in ("fecha_publicacion", "fecha_limite_presentacion")}
    out["adjudicatario_nif"] = bare(out["adjudicatario_nif"])
    out["todos_adjudicatarios_nif"] = F.when(F.size(awards) > 1, F.array_join(F.transform(awards, bare), ";")).otherwise("")
    out |= {"anuncio_primera_fecha": values.day_prefix(F.array_min(dates)), "anuncio_ultima_fecha": values.day_prefix(F.array_max(dates))}
    out |= {name: F.array_join(F.transform(of(path, field), lambda x: F.coalesce(x, F.lit(""))), ";") for name, path, field in (("cpv", "$.codigosCpv", "$"), ("provincias_ejecucion", "$.provinciasEjecucion", "$"), ("medios_publicacion", "$.mediosPublicacion", "$.codigo"))}
    out |= {name: F.size(items(path)) for name, path in (("num_adjudicaciones", "$.adjudicaciones"), ("num_lotes", "$.lotes"), ("num_anuncios", "$.anuncios"))}
    out["url_detalle"] = F.concat(F.lit(base + DETAIL), out["id_expediente"])
    return rows.select(*[c for c in rows.columns if c != document and c not in out], *[out[name].alias(name) for name in DOCUMENT])


#: Kinds of notices that award nothing, and so are one record.
NO_AWARD = ["cn-standard", "cn-social", "pin-buyer", "pin-standard"]


def notice_lots(notices: DataFrame, ids: list[str]) -> DataFrame:
    """A row for each lot of a notice with parallel arrays of text: ids, lot_index, value and the lot's fields. The value is the lot's tender, else its result, else its estimate, else the first tender; names and numbers of winners fall back to the last ones, offers, sizes and dates to the first.

    notices: notice_type and the arrays winner_names, winner_ids, winner_countries, winner_sizes, winner_dates, tender_values, result_values, estimated_values, offers, lot_ids, result_lot_ids.
    """
    size = lambda c: F.greatest(F.size(F.coalesce(c, F.expr("cast(array() as array<string>)"))), F.lit(0))
    n = F.when(F.col("notice_type").isin(NO_AWARD), 1).otherwise(F.greatest(size("winner_ids"), size("winner_names"), size("tender_values"), F.lit(1)))
    rows = notices.withColumn("__n", n).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    own = lambda c: F.nullif(F.get(c, F.col("__i")), F.lit(""))
    first, last = (lambda c: F.nullif(F.get(c, F.lit(0)), F.lit(""))), (lambda c: F.nullif(F.get(c, F.size(c) - 1), F.lit("")))
    chosen = {
        "value": [own("tender_values"), own("result_values"), own("estimated_values"), first("tender_values")],
        "win_name": [own("winner_names"), last("winner_names")],
        "win_nationalid": [own("winner_ids"), last("winner_ids")],
        "win_country": [own("winner_countries")],
        "win_size": [own("winner_sizes"), first("winner_sizes")],
        "number_offers": [own("offers"), first("offers")],
        "dt_award": [own("winner_dates"), first("winner_dates")],
        "lot_id": [own("lot_ids"), own("result_lot_ids")],
    }
    return rows.select(*ids, F.col("__i").alias("lot_index"), *[F.coalesce(*of, F.lit("")).alias(name) for name, of in chosen.items()])


def not_cancelled(notices: DataFrame) -> DataFrame:
    """F11."""
    return notices.where(F.coalesce(F.col("cancelled").cast("string"), F.lit("")) != "1")


#: Labels of a detail page and the columns they are for; the first label of a column counts.
DETAIL_LABELS = {
    "referencia": "referencia", "objeto": "objeto", "tipo_de_tramitacion": "tipo_tramitacion", "tipo_de_procedimiento": "tipo_procedimiento", "tipo_de_contrato": "tipo_contrato", "orzamento_base_de_licitacion": "presupuesto_base_text", "valor_estimado": "valor_estimado_text", "n_lotes": "num_lotes_text", "no_lotes": "num_lotes_text",
    "sistema_de_contratacion": "sistema_contratacion", "tipo_de_financiamento": "tipo_financiacion", "fecha_de_difusion_en_la_plataforma_de_contratos": "fecha_difusion_text", "sello": "sello", "fecha_formalizacion": "fecha_formalizacion_text", "organo": "organo", "direccion": "direccion", "localidad": "localidad", "c_p": "cp", "telefono": "telefono", "fax": "fax", "correo_electronico": "correo_electronico",
    "contrato_sara": "contrato_sara", "contratacion_centralizada": "contratacion_centralizada", "lei_nacional_de_aplicacion": "ley_nacional_aplicacion", "contrato_mixto": "contrato_mixto", "subasta_electronica": "subasta_electronica", "compra_publica_estratexica": "compra_publica_estrategica", "compra_publica_estrategica": "compra_publica_estrategica",
    "direccion_electronico": "direccion_electronica", "acuerdo_marco": "acuerdo_marco", "prorroga": "prorroga", "modificacion_objetiva_y_o_subjetiva": "modificacion",
}


def detail_records(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The columns of detail pages: labelled values, amounts and dates out of them, codes and counts of tables told by their headers. Pages of another title are left out."""
    parsed = readers.html_pages(pages, key, html).where(F.col("title").contains("Detalle proced"))
    label = lambda x: text.label_key(x)
    said = F.transform("pairs", lambda p: F.struct(label(p["label"]).alias("label"), p["value"].alias("value")))
    by_column: dict[str, list[str]] = {}
    for name, column in DETAIL_LABELS.items():
        by_column.setdefault(column, []).append(name)

    def first(names: list[str]) -> Column:
        return F.get(F.filter("said", lambda p: p["label"].isin(names)), F.lit(0))["value"]

    out = {column: first(names) for column, names in by_column.items()}
    amount = lambda c: values.spanish_number(out[c])
    out |= {"presupuesto_base_eur": amount("presupuesto_base_text"), "valor_estimado_eur": amount("valor_estimado_text"), "num_lotes": amount("num_lotes_text")}
    out |= {name: F.nullif(values.iso_text(out[f"{name}_text"]), F.lit("")) for name in ("fecha_difusion", "fecha_formalizacion")}
    has = lambda t, name: F.array_contains(t["header"], name)
    codes = lambda name: F.nullif(text.unique_join(F.flatten(F.transform(F.filter("told", lambda t: has(t, name)), lambda t: F.transform(t["rows"], lambda r: F.trim(F.get(r, F.greatest(F.array_position(t["header"], name) - 1, F.lit(0)).cast("int")))))), ", "), F.lit(""))
    exact = lambda *names: lambda t: F.array_join(t["header"], ",") == ",".join(names)
    rows_of = lambda which: F.nullif(F.aggregate(F.transform(F.filter("told", lambda t: which(t) & ~has(t, "codigo_cpv") & ~has(t, "nut")), lambda t: F.size(t["rows"])), F.lit(0), lambda a, b: a + b), F.lit(0))
    out |= {"cpv_codes": codes("codigo_cpv"), "nuts_codes": codes("nut")}
    out |= {"publicaciones_count": rows_of(exact("perfil", "bop", "dog", "boe", "fecha_envio_doue")), "documentos_count": rows_of(exact("titulo", "fecha", "estado", "descarga")), "adjudicaciones_count": rows_of(lambda t: has(t, "adjudicatario") & has(t, "importe")), "cambios_count": rows_of(exact("fecha", "cambio"))}
    told = F.transform("tables", lambda t: F.struct(F.transform(t["header"], label).alias("header"), t["rows"].alias("rows")))
    counted = parsed.withColumns({"said": said, "told": told})
    return counted.select(key, F.col("title").alias("detail_page_title"), F.size("pairs").alias("detail_pairs_count"), F.size("tables").alias("detail_tables_count"), *[c.alias(f"detail_{name}") for name, c in out.items()])
