"""Reading changelogs and annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import flag_set


def changes(
    changelog: DataFrame, track: Sequence[str] | None = None, registry: str | None = None,
    change_type: Sequence[str] | None = None, start=None, end=None, org_nr: Sequence[str] | None = None
) -> DataFrame:
    """Changelog rows by field (rows without a field stay), registry, kind, sync_date and organisation."""
    out = changelog
    if start is not None:
        out = out.where(F.col("sync_date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col("sync_date") <= F.lit(end).cast("date"))
    if registry is not None:
        out = out.where(F.col("registry") == registry)
    if change_type is not None:
        out = out.where(F.col("change_type").isin(list(change_type)))
    if org_nr is not None:
        out = out.where(F.col("org_nr").isin(list(org_nr)))
    if track is not None:
        out = out.where(F.col("field").isNull() | F.col("field").isin(list(track)))
    return out.orderBy("timestamp", "update_id", "org_nr", "field")


def change_summary(changelog: DataFrame) -> DataFrame:
    """Counts by registry, kind and field (A5)."""
    return changelog.groupBy("registry", "change_type", "field").agg(F.count("*").alias("n")).orderBy("registry", F.desc("n"))


def change_totals(changelog: DataFrame) -> DataFrame:
    """Changed organisations and rows by kind."""
    return changelog.groupBy("change_type").agg(F.count_distinct("org_nr").alias("n_entities"), F.count("*").alias("n"))


def annotations(
    state: DataFrame, org_nr: Sequence[str] | None = None, infotype: Sequence[str] | None = None,
    infotypes: DataFrame | None = None, cleared: DataFrame | None = None
) -> DataFrame:
    """Annotations of entities (F4): with ``infotypes`` infotype_desc after infotype, with ``cleared`` (a changelog)
    a column active and the organisations whose annotations were cleared, active false."""
    out, columns = state, list(state.columns)
    if cleared is not None:
        gone = cleared.where("change_type = 'annotation_cleared'").select("org_nr").distinct().join(state.select("org_nr"), "org_nr", "left_anti")
        out = out.withColumn("active", F.lit(True)).unionByName(gone.withColumn("active", F.lit(False)), allowMissingColumns=True)
        columns.append("active")
    if org_nr is not None:
        out = out.where(F.col("org_nr").isin(list(org_nr)))
    if infotype is not None:
        out = out.where(F.col("infotype").isin(list(infotype)))
    if infotypes is not None:
        codes = infotypes.select(F.col("code").alias("infotype"), F.col("label").alias("_label"))
        out = out.join(codes, "infotype", "left").withColumn("infotype_desc", F.coalesce("_label", "infotype"))
        columns.insert(columns.index("infotype") + 1, "infotype_desc")
    return out.select(*columns)


def annotation_summary(state: DataFrame) -> DataFrame:
    """Entities and annotations by kind."""
    return state.groupBy("infotype").agg(F.count_distinct("org_nr").alias("n_entities"), F.count("*").alias("n_annotations")).orderBy(F.desc("n_annotations"), "infotype")


def explode_annotations(entities: DataFrame, column: str = "annotations", flag: str | None = None) -> DataFrame:
    """(org_nr, position from 0, infotype, tekst, innfoert_dato) of entities with an annotation array."""
    rows = entities if flag is None else entities.where(flag_set(flag))
    out = rows.select("org_nr", F.posexplode(column).alias("position", "_a"))
    return out.select("org_nr", "position", F.col("_a.infotype").alias("infotype"), F.col("_a.tekst").alias("tekst"), F.col("_a.innfoertDato").alias("innfoert_dato"))


def apply_annotation_patches(state: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state, changelog rows) after patches of ``paategninger``.

    ``patches`` has org_nr, update_id, timestamp, operation, field and new_value. A removal or NULL of the whole
    array clears an entity's annotations, and the log tells how many; items added at its end (a field that ends in
    ``-`` and the item's part) come next in position; edits of single items are passed over. Within a batch an
    entity's last clearing decides: items added before it do not come back.
    """
    whole = F.lower("field") == "paategninger"
    clears = patches.where(whole & (F.lower("operation").isin("remove", "replace")) & (F.col("new_value").isNull() | (F.col("new_value") == "[]")))
    last = clears.groupBy("org_nr").agg(F.max("update_id").alias("_cleared"), F.max_by("timestamp", "update_id").alias("_at"))
    added = patches.where(F.lower("field").rlike(r"^paategninger_-_")).withColumn("_part", F.regexp_replace("field", r"^.*_-_", ""))
    items = added.groupBy("org_nr", "update_id", "timestamp").agg(
        *[F.max(F.when(F.col("_part") == p, F.col("new_value"))).alias(n) for p, n in (("infotype", "infotype"), ("tekst", "tekst"), ("innfoertDato", "innfoert_dato"))]
    )
    items = items.join(last, "org_nr", "left").where("_cleared IS NULL OR update_id > _cleared")
    rest = state.join(last.select("org_nr"), "org_nr", "left_anti")
    held = rest.groupBy("org_nr").agg((F.max("position") + 1).alias("_next"))
    place = F.row_number().over(W.partitionBy("org_nr").orderBy("update_id")) - 1
    fresh = items.join(held, "org_nr", "left").withColumn("position", (place + F.coalesce("_next", F.lit(0))).cast("int"))
    new_state = rest.unionByName(fresh.select(*state.columns))
    count = state.groupBy("org_nr").agg(F.count("*").cast("string").alias("value_from"))
    none = F.lit(None).cast("string")
    meta = lambda kind: [F.lit("paategninger").alias("registry"), F.lit(kind).alias("change_type")]
    cleared = last.join(count, "org_nr", "left").select(F.col("_at").cast("string").alias("timestamp"), "org_nr", *meta("annotation_cleared"), F.lit("paategninger").alias("field"), F.coalesce("value_from", F.lit("0")).alias("value_from"), none.alias("value_to"), F.col("_cleared").alias("update_id"))
    logged = fresh.select(F.col("timestamp").cast("string").alias("timestamp"), "org_nr", *meta("annotation_added"), F.col("infotype").alias("field"), none.alias("value_from"), F.col("tekst").alias("value_to"), "update_id")
    return new_state, cleared.unionByName(logged)
