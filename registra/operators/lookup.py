"""Point lookups and searches over entity and role tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_org_nr


def entity(org_nr: str, main: DataFrame, sub: DataFrame, deleted: DataFrame | None = None, registry: str = "auto") -> DataFrame:
    """The entity of a number (S1): the main register's, else the sub-units', else its tombstone; with its registry."""
    if not is_org_nr(org_nr):
        raise ValueError(f"{org_nr!r} is not an organisation number")
    sides = [(main, "enheter"), (sub, "underenheter")]
    found = [df.where(F.col("org_nr") == org_nr).withColumns({"registry": F.lit(n), "_rank": F.lit(k)}) for k, (df, n) in enumerate(sides) if registry in ("auto", n)]
    out = found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)
    if deleted is not None:
        gone = deleted.where(F.col("org_nr") == org_nr).withColumns({"deleted": F.lit(True), "_rank": F.lit(2)})
        out = out.unionByName(gone, allowMissingColumns=True)
    return out.orderBy("_rank").limit(1).drop("_rank")


def search(
    entities: DataFrame, name: str | None = None, legal_form: Sequence[str] | None = None,
    municipality_code: Sequence[str] | None = None, nace_code: str | None = None, min_employees: int | None = None,
    max_employees: int | None = None, bankrupt: bool | None = None, parent_org_nr: str | None = None,
    max_results: int = 200, municipality_column: str = "municipality_code"
) -> tuple[DataFrame, DataFrame]:
    """(the first ``max_results`` matches by org_nr, the number of all matches as one row total_matches)."""
    out = entities
    if name is not None:
        out = out.where(F.lower("name").contains(name.lower()))
    for column, values in (("legal_form", legal_form), (municipality_column, municipality_code)):
        if values is not None:
            out = out.where(F.col(column).isin(list(values)))
    if nace_code is not None:
        out = out.where(F.col("nace_1").startswith(nace_code))
    if min_employees is not None:
        out = out.where(F.col("employees") >= min_employees)
    if max_employees is not None:
        out = out.where(F.col("employees") <= max_employees)
    if bankrupt is not None:
        out = out.where(F.col("bankrupt") == bankrupt)
    if parent_org_nr is not None:
        out = out.where(F.col("parent_org_nr") == parent_org_nr)
    return out.orderBy("org_nr").limit(max_results), out.agg(F.count("*").alias("total_matches"))


def owned_by(entities: DataFrame, org_nr: str) -> DataFrame:
    """Sub-units, or organisations one level below, of a parent."""
    return entities.where(F.col("parent_org_nr") == org_nr)


def roles_of(roles: DataFrame, org_nr: str) -> DataFrame:
    """Role rows of an entity."""
    return roles.where(F.col("org_nr") == org_nr)


def legal_roles(roles: DataFrame, entities: DataFrame, org_nrs: Sequence[str] | None = None) -> DataFrame:
    """Roles that entities hold in other organisations."""
    held = roles.where("entity_org_nr IS NOT NULL")
    held = held if org_nrs is None else held.where(F.col("entity_org_nr").isin(list(org_nrs)))
    names = entities.select(F.col("org_nr").alias("target_org_nr"), F.col("name").alias("target_name"))
    out = held.select(
        F.col("entity_org_nr").alias("org_nr"), F.col("org_nr").alias("target_org_nr"), "role_code", "role", F.lit(None).cast("string").alias("share"),
        F.coalesce("resigned", F.lit(False)).alias("resigned"), F.coalesce("deregistered", F.lit(False)).alias("deregistered"),
    )
    return out.join(names, "target_org_nr", "left").select("org_nr", "target_org_nr", "target_name", "role_code", "role", "share", "resigned", "deregistered")


def filter_table(df: DataFrame, column: str, values: Sequence | DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose value is among ``values`` (F2): a list for a few, a DataFrame of one column for many."""
    out = df.join(values.toDF(column).distinct(), column, "left_semi") if isinstance(values, DataFrame) else df.where(F.col(column).isin(list(values)))
    return out if columns is None else out.select(*columns)
