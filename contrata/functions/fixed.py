"""Code lists, thresholds and patterns that results depend on."""

#: EU thresholds by two-year period: works, services of the state, other services, utilities.
THRESHOLDS = [
    (2010, 2011, 4_845_000, 125_000, 193_000, 387_000),
    (2012, 2013, 5_000_000, 130_000, 200_000, 400_000),
    (2014, 2015, 5_186_000, 134_000, 207_000, 414_000),
    (2016, 2017, 5_225_000, 135_000, 209_000, 418_000),
    (2018, 2019, 5_548_000, 144_000, 221_000, 443_000),
    (2020, 2021, 5_350_000, 139_000, 214_000, 428_000),
    (2022, 2023, 5_382_000, 140_000, 215_000, 431_000),
    (2024, 2025, 5_538_000, 143_000, 221_000, 443_000),
    (2026, 2027, 5_404_000, 140_000, 216_000, 432_000),
]
#: Contract types that no threshold applies to.
NO_THRESHOLD = ["Privado", "Patrimonial", "Administrativo Especial", "Gestion Servicios Publicos", "22", "32", "999", "nan", ""]
#: Parts of buyers' names that mean the state's administration.
STATE = ["ADMINISTRACION DEL ESTADO", "ADMINISTRACION GENERAL DEL ESTADO", "Ministerio", "TRAGSA", "SEPI", "AENA", "RENFE", "ADIF", "CORREOS", "MUFACE", "INGESA", "TGSS", "Tesoreria General", "Agencia Estatal", "Agencia Tributaria", "Seguridad Social", "Patrimonio Nacional", "Instituto Nacional", "CSIC", "AEMET", "DGT", "Guardia Civil", "Ejercito", "Armada", "BOE", "FNMT", "ICO ", "ICEX", "CDTI"]
#: Parts of buyers' names that mean a utility.
UTILITIES = ["AENA", "RENFE", "ADIF", "CORREOS", "Puertos del Estado", "Autoridad Portuaria", "ENAGAS", "Canal de Isabel II", "Aguas de", "EMASA", "EMASESA", "ACUAES", "Metro de", "Transports de Barcelona", "TMB", "FGC", "Ferrocarrils"]
#: Words of buyers' names that tell nothing.
STOPWORDS = ["DE", "DEL", "LA", "LAS", "LOS", "EL", "EN", "Y", "E", "A", "AL", "S", "SA", "SL", "SLU", "SAU", "SME", "MP", "EP", "CONSEJO", "ADMINISTRACION", "DIRECCION", "GENERAL", "JUNTA", "GOBIERNO", "LOCAL", "PROVINCIAL", "GERENCIA", "PRESIDENCIA", "DIRECTOR", "GERENTE", "PRESIDENTE", "VICEPRESIDENTE"]
#: Legal forms at the end of company names.
LEGAL_FORMS = [
    "SOCIEDAD ANONIMA DEPORTIVA", "SOCIEDAD ANONIMA", "SOCIEDAD LIMITADA PROFESIONAL", "SOCIEDAD LIMITADA LABORAL", "SOCIEDAD LIMITADA NUEVA EMPRESA", "SOCIEDAD LIMITADA", "SOCIEDAD COOPERATIVA ANDALUZA", "SOCIEDAD COOPERATIVA", "SOCIEDAD CIVIL PROFESIONAL", "SOCIEDAD CIVIL", "SOCIEDAD UNIPERSONAL", "AGRUPACION DE INTERES ECONOMICO",
    "SAU", "SLU", "SAD", "SLL", "SLP", "SLNE", "SA SME", "SAE", "SME", "SA", "SL", "SC", "SCA", "SCCL", "SCOOP", "SE", "SRL", "AIE",
]
#: Abbreviations of legal forms, letter by letter: those written with points, with spaces, and with spaces at the end only.
DOTTED_FORMS = ["SRL", "SLU", "SLP", "SLL", "SL", "SAU", "SAE", "SA", "SC", "AIE", "SME"]
SPACED_FORMS = ["SRL", "SME", "SLU", "SLP", "SLL", "SAU", "SAE"]
FINAL_FORMS = ["SL", "SA"]
#: What the quality score takes out of company names, wherever it stands.
QUALITY_FORMS = [" SOCIEDAD LIMITADA", " SOCIEDAD ANONIMA", " S.L.U.", " S.L.L.", " S.L.", " S.A.U.", " S.A.", " SLU", " SLL", " SLP", " SL", " SAU", " SA", " S.COOP", " SCOOP", " S COOP", " S.C.", " SC", " UNIPERSONAL", " EN CONSTITUCION", ",", ".", "-"]
#: Legal forms that the gazette's parser takes off, one of them, after a space.
PARSER_FORMS = [
    "SOCIEDAD ANONIMA DEPORTIVA", "SOCIEDAD ANONIMA", "SOCIEDAD LIMITADA PROFESIONAL", "SOCIEDAD LIMITADA LABORAL", "SOCIEDAD LIMITADA NUEVA EMPRESA", "SOCIEDAD LIMITADA", "SOCIEDAD COOPERATIVA ANDALUZA", "SOCIEDAD COOPERATIVA", "SOCIEDAD CIVIL PROFESIONAL", "SOCIEDAD CIVIL", "AGRUPACION DE INTERES ECONOMICO",
    "SAU", "SLU", "SAD", "SLL", "SLP", "SLNE", "SA SME", "SA", "SL", "SC", "SCA", "SCCL", "SCOOP", "SE", "SRL", "AIE",
]
#: Patterns of the health sector's buyers.
HEALTH = [
    "SALUD", "SANITARI", "HOSPITAL", "CLINIC[AO]", "OSAKIDETZA", "SERGAS", "SACYL", "SESCAM", "OSASUNBIDEA", "INGESA", "IB.SALUT", r"ICS\b", "INSTITUT CATALA DE LA SALUT",
    "SERVICIO ANDALUZ", "SERVICIO CANARIO", "SERVICIO MURCIANO", "SERVICIO RIOJANO", "SERVICIO NAVARRO", "SERVICIO EXTREMEÑO", "SERVICIO ARAGONES", "SERVICIO GALLEGO", "SERVEI BALEAR", "SERVEI CATALA",
    "AREA DE SALUD", "GERENCIA DE ATENCION", "FARMACI", "MEDICAMENT", "CENTRO DE TRANSFUSION", "AMBULANCI", "EMERGENCI", "061", "112 SANITARI", "MUFACE", "FREMAP", "MUTUA", "AECC", "CRUZ ROJA",
]
#: Regions by parts of buyers' names, the first that fits.
REGIONS = {
    "Andalucia": ["ANDALUZ", "JUNTA DE ANDALUCIA", "SAS"], "Cataluña": ["CATALA", "GENERALITAT DE CATALUN", "ICS"], "Madrid": ["MADRID", "COMUNIDAD DE MADRID", "SERMAS"], "C. Valenciana": ["VALENCIA", "GENERALITAT VALENCIANA"], "Galicia": ["GALLEGO", "SERGAS", "XUNTA"], "Pais Vasco": ["OSAKIDETZA", "EUSKO"],
    "Castilla y Leon": ["SACYL", "CASTILLA Y LEON"], "Canarias": ["CANARIO", "CANARIAS"], "Baleares": ["BALEAR", "IB.SALUT"], "Aragon": ["ARAGON"], "Asturias": ["ASTURIAS", "SESPA"], "Murcia": ["MURCIANO", "MURCIA"],
    "Extremadura": ["EXTREMEÑO", "EXTREMADURA"], "Castilla-La Mancha": ["SESCAM", "CASTILLA.LA MANCHA"], "Navarra": ["NAVARRO", "OSASUNBIDEA", "NAVARRA"], "La Rioja": ["RIOJANO", "RIOJA"], "Cantabria": ["CANTABRIA"], "AGE (INGESA, MUFACE...)": ["INGESA", "MUFACE", "FREMAP"],
}
#: Bands of amounts in the health sector's study.
HEALTH_BANDS = [(0.0, 221_000.0), (221_000.0, 500_000.0), (500_000.0, 1_000_000.0), (1_000_000.0, 5_000_000.0), (5_000_000.0, float("inf"))]
#: Words of buyers' names that aren't key words.
COMMON_WORDS = ["DE", "DEL", "LA", "LAS", "LOS", "EL", "EN", "POR", "PARA", "CON", "SIN", "UNA", "UNO", "QUE", "MAS", "GENERAL", "NACIONAL", "COMUNIDAD", "AUTONOMA", "ESTADO", "SECTOR", "PUBLICO", "PUBLICA", "SERVICIO", "SERVICIOS", "DIRECCION", "SUBDIREC", "AREA", "UNIDAD", "JEFATURA"]
#: Control letters of personal and company identifiers.
PERSON_LETTERS, COMPANY_LETTERS, COMPANY_TYPES = "TRWAGMYFPDXBNJZSQVHLCKE", "JABCDEFGHI", "ABCDEFGHJNPQRSUVW"
#: Limits of the quality indicators.
LEAST_AMOUNT, FIRST_DATE, LAST_DATE = 1.0, "1990-01-01", "2030-12-31"
MINOR_WORKS, MINOR_OTHER, AWARD_TOLERANCE, MOST_OFFERS, MOST_DAYS, MOST_BUDGET = 40_000, 15_000, 0.05, 500, 365, 50_000_000
#: Matching tolerances (share, absolute), and those for grouped lots.
TOLERANCE, WIDE_TOLERANCE = (0.10, 5_000.0), (0.15, 20_000.0)
#: buyers' names and those that they have in notices, normalised and cut to 40 characters; notices' names of 5 characters or fewer aren't looked up.
ALIASES = {
    "ADIF PRESIDENCIA": ["ADMINISTRADOR DE INFRAESTRUCTURAS FERROV", "ADIF"],
    "ADIF CONSEJO DE ADMINISTRACION": ["ADMINISTRADOR DE INFRAESTRUCTURAS FERROV", "ADIF"],
    "ADIF ALTA VELOCIDAD PRESIDENCIA": ["ADIF ALTA VELOCIDAD", "ADIF AV"],
    "ADIF ALTA VELOCIDAD CONSEJO DE ADMINISTR": ["ADIF ALTA VELOCIDAD", "ADIF AV"],
    "EMPRESA PUBLICA DE METRO DE MADRID S A": ["METRO DE MADRID S A"],
    "INSTITUT CATALA DE LA SALUT ICS": ["INSTITUT CATALA DE LA SALUT", "ICS"],
    "CONSELLERIA DE SANIDADE SERGAS": ["SERVIZO GALEGO DE SAUDE", "SERGAS"],
    "HOSPITAL UNIVERSITARIO DOCE DE OCTUBRE": ["HOSPITAL UNIVERSITARIO 12 DE OCTUBRE", "HOSPITAL 12 DE OCTUBRE"],
    "HOSPITAL LA PAZ": ["HOSPITAL UNIVERSITARIO LA PAZ"],
    "PARADORES DE TURISMO DE ESPANA S M E S A": ["PARADORES DE TURISMO DE ESPANA S A"],
    "AENA DIRECCION DEL AEROPUERTO ADOLFO SUA": ["AENA S M E S A", "AENA CONSEJO DE ADMINISTRACION"],
    "AENA DIRECCION DE CONTRATACION": ["AENA S M E S A", "AENA CONSEJO DE ADMINISTRACION"],
    "SERVEI CATALA DE LA SALUT CATSALUT": ["SERVEI CATALA DE LA SALUT", "CATSALUT"],
    "COMITE CENTRAL DE COMPRAS DE NAVANTIA S": ["NAVANTIA S A S M E", "NAVANTIA"],
    "HOSPITAL UNIVERSITARIO DE FUENLABRADA": ["HOSPITAL UNIVERSITARIO DE FUENLABRADA"],
    "DIRECCION GENERAL DE RACIONALIZACION Y C": ["DIRECCION GENERAL DE RACIONALIZACION Y C", "JUNTA DE CONTRATACION CENTRALIZADA"],
}
