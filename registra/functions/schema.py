"""Field dictionary and canonical schemas of the registry's tables."""

from __future__ import annotations

from pyspark.sql import types as T

from .types import fields

#: Path of a field in the source, its column, its type. Two columns have two spellings of their path.
FIELDS: tuple[tuple[str, str, str], ...] = (
    ("organisasjonsnummer", "org_nr", "string"),
    ("navn", "name", "string"),
    ("organisasjonsform.kode", "legal_form", "string"),
    ("organisasjonsform.beskrivelse", "legal_form_desc", "string"),
    ("stiftelsesdato", "founding_date", "date"),
    ("registreringsdatoEnhetsregisteret", "registration_date", "date"),
    ("antallAnsatte", "employees", "int"),
    ("harRegistrertAntallAnsatte", "employees_reported", "boolean"),
    ("hjemmeside", "website", "string"),
    ("naeringskode1.kode", "nace_1", "string"),
    ("naeringskode1.beskrivelse", "nace_1_desc", "string"),
    ("naeringskode2.kode", "nace_2", "string"),
    ("naeringskode2.beskrivelse", "nace_2_desc", "string"),
    ("naeringskode3.kode", "nace_3", "string"),
    ("naeringskode3.beskrivelse", "nace_3_desc", "string"),
    ("institusjonellSektorkode.kode", "sector_code", "string"),
    ("institusjonellSektorkode.beskrivelse", "sector_desc", "string"),
    ("forretningsadresse.adresse", "business_address", "string"),
    ("forretningsadresse.postnummer", "business_postcode", "string"),
    ("forretningsadresse.poststed", "business_city", "string"),
    ("forretningsadresse.kommunenummer", "municipality_code", "string"),
    ("forretningsadresse.kommune", "municipality", "string"),
    ("forretningsadresse.landkode", "country_code", "string"),
    ("forretningsadresse.land", "country", "string"),
    ("postadresse.adresse", "postal_address", "string"),
    ("postadresse.postnummer", "postal_postcode", "string"),
    ("postadresse.poststed", "postal_city", "string"),
    ("postadresse.kommunenummer", "postal_municipality_code", "string"),
    ("postadresse.kommune", "postal_municipality", "string"),
    ("postadresse.landkode", "postal_country_code", "string"),
    ("postadresse.land", "postal_country", "string"),
    ("beliggenhetsadresse.adresse", "location_address", "string"),
    ("beliggenhetsadresse.postnummer", "location_postcode", "string"),
    ("beliggenhetsadresse.poststed", "location_city", "string"),
    ("beliggenhetsadresse.kommunenummer", "location_municipality_code", "string"),
    ("beliggenhetsadresse.kommune", "location_municipality", "string"),
    ("beliggenhetsadresse.landkode", "location_country_code", "string"),
    ("beliggenhetsadresse.land", "location_country", "string"),
    ("utenlandskRegisterAdresse.adresse", "foreign_reg_address", "string"),
    ("utenlandskRegisterAdresse.land", "foreign_reg_country", "string"),
    ("utenlandskRegisterAdresse.poststed", "foreign_reg_city", "string"),
    ("konkurs", "bankrupt", "boolean"),
    ("konkursdato", "bankruptcy_date", "date"),
    ("underAvvikling", "in_liquidation", "boolean"),
    ("underAvviklingDato", "liquidation_date", "date"),
    ("underTvangsavviklingEllerTvangsopplosning", "forced_dissolution", "boolean"),
    ("tvangsavvikletPgaManglendeSlettingDato", "forced_dissolution_deletion_date", "date"),
    ("tvangsopplostPgaMangelfulltStyreDato", "forced_dissolution_board_date", "date"),
    ("tvangsopplostPgaManglendeRegnskapDato", "forced_dissolution_accounts_date", "date"),
    ("tvangsopplostPgaManglendeRevisorDato", "forced_dissolution_auditor_date", "date"),
    ("registrertIMvaregisteret", "vat_registered", "boolean"),
    ("registreringsdatoMerverdiavgiftsregisteret", "vat_registration_date", "date"),
    ("registreringsdatoFrivilligMerverdiavgiftsregisteret", "voluntary_vat_reg_date", "date"),
    ("frivilligMvaRegistrertBeskrivelser", "voluntary_vat_descriptions", "string"),
    ("registrertIForetaksregisteret", "in_business_register", "boolean"),
    ("registreringsdatoForetaksregisteret", "business_register_date", "date"),
    ("registrertIFrivillighetsregisteret", "in_nonprofit_register", "boolean"),
    ("registreringsdatoFrivillighetsregisteret", "nonprofit_register_date", "date"),
    ("registrertIStiftelsesregisteret", "in_foundation_register", "boolean"),
    ("overordnetEnhet", "parent_org_nr", "string"),
    ("erIKonsern", "in_corporate_group", "boolean"),
    ("vedtektsfestetFormaal", "purpose", "string"),
    ("vedtektsdato", "articles_date", "date"),
    ("sisteInnsendteAarsregnskap", "last_annual_accounts", "int"),
    ("maalform", "language_form", "string"),
    ("aktivitet", "activity", "string"),
    ("slettedato", "deletion_date", "date"),
    ("nedleggelsesdato", "closure_date", "date"),
    ("datoEierskifte", "ownership_change_date", "date"),
    ("fravalgRevisjonDato", "audit_exemption_date", "date"),
    ("fravalgRevisjonBeslutningsDato", "audit_exemption_decision_date", "date"),
    ("registreringsdatoMerverdiavgiftsregisteretEnhetsregisteret", "vat_reg_date_er", "date"),
    ("registreringsdatoAntallAnsatteEnhetsregisteret", "employee_reg_date_er", "date"),
    ("registreringsdatoAntallAnsatteNavAaregisteret", "employee_reg_date_nav", "date"),
    ("registreringsdatoAntallAnsatteNAVAaregisteret", "employee_reg_date_nav", "date"),
    ("registreringsdatoIEnhetsregisteret", "registration_date", "date"),
    ("oppstartsdato", "start_date", "date"),
    ("registrertIPartiregisteret", "in_party_register", "boolean"),
    ("registreringsdatoPartiregisteret", "party_register_date", "date"),
    ("telefon", "phone", "string"),
    ("mobil", "mobile", "string"),
    ("epostadresse", "email", "string"),
    ("kapital.belop", "capital_amount", "double"),
    ("kapital.antallAksjer", "capital_shares", "double"),
    ("kapital.valuta", "capital_currency", "string"),
    ("kapital.type", "capital_type", "string"),
    ("kapital.innfortDato", "capital_date", "date"),
    ("kapital.fulltInnbetalt", "capital_fully_paid", "boolean"),
    ("kapital.innbetalt", "capital_paid_in", "double"),
    ("kapital.bundet", "capital_restricted", "double"),
    ("hjelpeenhetskode.kode", "auxiliary_unit_code", "string"),
    ("hjelpeenhetskode.beskrivelse", "auxiliary_unit_desc", "string"),
    ("paategninger", "annotations", "string"),
    ("utenlandskRegisterNavn", "foreign_register_name", "string"),
    ("registreringsnummerIHjemlandet", "foreign_registration_number", "string"),
    ("underlagtLovgivningLand", "foreign_law_country", "string"),
    ("underlagtLovgivningLandKode", "foreign_law_country_code", "string"),
    ("foretaksformIHjemlandet.kode", "foreign_legal_form", "string"),
    ("foretaksformIHjemlandet.beskrivelse", "foreign_legal_form_desc", "string"),
    ("foretaksformIHjemlandet.beskrivelseBokmaal", "foreign_legal_form_desc_bm", "string"),
    ("underRekonstruksjonsforhandlingDato", "reconstruction_date", "date"),
    ("underUtenlandskInsolvensbehandlingDato", "foreign_insolvency_date", "date"),
    ("respons_klasse", "response_class", "string"),
)

#: column -> type, in dictionary order.
COLUMN_TYPES: dict[str, str] = {column: kind for _, column, kind in FIELDS}
#: lower-case path -> column.
PATH_COLUMNS: dict[str, str] = {path.lower(): column for path, column, _ in FIELDS}

ROLES = fields(
    "org_nr string, role_group_code string, role_group string, role_code string, role string, first_name string, middle_name string, "
    "last_name string, birth_date date, deceased boolean, entity_org_nr string, entity_name string, resigned boolean, deregistered boolean, "
    "ordering int, elected_by string, group_modified date, person_id string"
)
LEGAL_ROLES = fields(
    "org_nr string, target_org_nr string, target_name string, role_code string, role string, share string, resigned boolean, deregistered boolean"
)
SIGNING = fields(
    "org_nr string, entity_name string, signature_type string, rule_status string, rule_text string, combination_id string, "
    "combination_code string, rule string, name string, birth_date date, role_code string, role string"
)
ANNOTATIONS = fields("org_nr string, position int, infotype string, tekst string, innfoert_dato string")
CHANGELOG = fields(
    "timestamp string, org_nr string, registry string, change_type string, field string, value_from string, value_to string, update_id long"
)
PATCHES = T.ArrayType(fields("operation string, field string, new_value string"))
UPDATES = fields("update_id long, org_nr string, change_type string, timestamp timestamp").add("changes", PATCHES)
MANIFEST = fields(
    "id string, type string, snapshot_date string, endpoint string, format string, download_timestamp string, last_modified string, "
    "etag string, file_hash string, record_count long, raw_path string, parquet_path string, cdc_bridge_first_update_id long"
)
SNAPSHOTS = fields("snapshot_date date, file_size long, path string")
NODES = fields("node_id string, node_type string, name string, org_nr string, person_id string")
EDGES = fields("from string, to string, edge_type string, role_code string, role string")

#: Kinds of changes as the source names them.
INSERTED, CHANGED, DELETED = ("Ny",), ("Endring",), ("Sletting", "Fjernet")

#: Columns of a role that a difference reports, in order; a birth date is part of the person, not of the role.
ROLE_VALUES = (
    "role_group", "role", "first_name", "middle_name", "last_name", "deceased", "entity_org_nr", "entity_name",
    "resigned", "deregistered", "ordering", "elected_by", "group_modified",
)


def empty(spark, schema: T.StructType):
    """A typed table without rows."""
    return spark.createDataFrame([], schema)
