"""Code lists of the registry. NACE, sector and correspondence tables are the user's: pass them where they are needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Legal forms in English.
LEGAL_FORMS = {
    "AS": "Private limited company", "ASA": "Public limited company", "ENK": "Sole proprietorship",
    "ANS": "General partnership (joint liability)", "DA": "General partnership (shared liability)", "KS": "Limited partnership",
    "NUF": "Norwegian-registered foreign entity", "BA": "Company with limited liability", "SA": "Cooperative", "STI": "Foundation",
    "FLI": "Association / club", "SPA": "Savings bank", "SF": "State enterprise", "BBL": "Housing cooperative association",
    "BRL": "Housing cooperative", "PK": "Pension fund", "IKS": "Inter-municipal company", "KF": "Municipal enterprise",
    "FKF": "County municipal enterprise", "GFS": "Mutual insurance company", "SE": "European company (SE)", "KOMM": "Municipality",
    "FYLK": "County authority", "STAT": "The State", "ORGL": "Organizational unit (public)", "ADOS": "Administrative unit (public)",
    "KBO": "Bankruptcy estate", "BO": "Other estate", "SAM": "Joint ownership (real property)", "ESEK": "Sectional ownership",
    "PRE": "Shipping partnership", "ANNA": "Other legal person", "BEDR": "Establishment (business sub-unit)",
    "AAFY": "Establishment (non-business sub-unit)", "OPMV": "Split VAT entity", "KIRK": "Church of Norway",
    "PERS": "Individual in associated register", "IKJP": "Other non-legal person", "KTRF": "Office partnership",
    "EOFG": "European economic interest grouping", "VPFO": "Securities fund", "EOEFG": "European economic interest grouping (alt)",
    "SER": "European cooperative society",
}
#: Roles, in English and in Norwegian.
ROLE_TYPES = {
    "LEDE": ("Chair of the Board", "Styrets leder"), "NEST": ("Deputy Chair", "Nestleder"), "MEDL": ("Board Member", "Styremedlem"),
    "VARA": ("Alternate Board Member", "Varamedlem"), "OBS": ("Observer", "Observatør"), "DAGL": ("CEO / Managing Director", "Daglig leder"),
    "INNH": ("Sole Proprietor", "Innehaver"), "REVI": ("Auditor", "Revisor"), "REGN": ("Accountant", "Regnskapsfører"),
    "KONT": ("Contact Person", "Kontaktperson"), "DTPR": ("Partner (full liability)", "Deltaker med proratarisk ansvar"),
    "DTSO": ("Partner (limited liability)", "Deltaker med solidarisk ansvar"), "BEST": ("Managing Shipowner", "Bestyrende reder"),
    "BOBE": ("Bankruptcy Trustee", "Bostyrer"), "KOMP": ("General Partner (KS)", "Komplementar"),
    "REPR": ("Norwegian Representative", "Norsk representant"), "FFØR": ("Bookkeeper", "Forretningsfører"), "SAM": ("Co-owner", "Sameier"),
    "SIGN": ("Signature Right", "Signatur"), "SIFE": ("Signature Right (Jointly)", "Signatur i fellesskap"),
    "SIHV": ("Signature Right (Separately)", "Signatur hver for seg"), "PROK": ("Power of Procuration", "Prokura"),
    "POFE": ("Power of Procuration (Jointly)", "Prokura i fellesskap"), "POHV": ("Power of Procuration (Separately)", "Prokura hver for seg"),
}
#: Groups of roles, in English and in Norwegian.
ROLE_GROUPS = {
    "STYR": ("Board of Directors", "Styre"), "DAGL": ("Management", "Daglig leder/adm.dir"), "REVI": ("Auditor", "Revisor"),
    "REGN": ("Accountant", "Regnskapsfører"), "EIKM": ("Owner Municipalities", "Eierkommuner"), "KOMP": ("General Partners", "Komplementarer"),
    "DTPR": ("Partners (full liability)", "Deltakere med proratarisk ansvar"), "DTSO": ("Partners (limited)", "Deltakere med solidarisk ansvar"),
    "INNH": ("Proprietor", "Innehaver"), "KONT": ("Contact", "Kontaktperson"), "BEST": ("Managing Shipowner", "Bestyrende reder"),
    "BOBE": ("Bankruptcy Trustee", "Bostyrer"), "FFØR": ("Bookkeeper", "Forretningsfører"), "SAM": ("Co-owners", "Sameiere"),
    "HLSE": ("Health/Environment/Safety", "Helse, miljø og sikkerhet"),
}
#: Kinds of annotations in English.
INFOTYPES = {
    "NAVN": "Name annotation", "FADR": "Business address presumed incorrect", "KONT": "Missing contact person",
    "DAGL": "Missing general manager", "FFØR": "Missing business manager", "REPR": "Missing Norwegian representative",
    "SAM": "Incomplete co-owner information",
}

_BUILT_IN = {
    "legal_form": LEGAL_FORMS, "role_code": {k: v[0] for k, v in ROLE_TYPES.items()},
    "role_group_code": {k: v[0] for k, v in ROLE_GROUPS.items()}, "infotype": INFOTYPES,
}


def dictionary(spark: SparkSession, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """A code list as (code, label) (S15): one of the user's ``tables``, or a built-in one."""
    if tables and name in tables:
        return tables[name]
    if name not in _BUILT_IN:
        raise ValueError(f"no code list {name!r}: pass it in tables; built in are {sorted(_BUILT_IN)}")
    return spark.createDataFrame(list(_BUILT_IN[name].items()), "code string, label string")


def label_tables(spark: SparkSession, tables: dict[str, DataFrame] | None = None, language: str = "en") -> dict[str, DataFrame]:
    """Code lists by the columns they label (L2). NACE and sector lists follow ``language``: name them nace_en and so on."""
    out = {c: dictionary(spark, c, tables) for c in ("legal_form", "role_code", "role_group_code")}
    for name, columns in (("nace", ("nace_1", "nace_2", "nace_3", "nace_1_desc")), ("sector", ("sector_code",))):
        found = (tables or {}).get(f"{name}_{language}") if tables else None
        found = found if found is not None else (tables or {}).get(name)
        if found is not None:
            out |= dict.fromkeys(columns, found)
    return out
