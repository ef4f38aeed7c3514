"""Point-in-time replay of a change feed over a base table, and field-level changelogs, as window algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import schema
from ..functions.exprs import as_type, shown, snake_name


def field_column(field: str, columns: Sequence[str]) -> str | None:
    """The column that a patch field means (P18): by the dictionary, by its snake name, or none.

    Fields are paths with underscores for dots; both spellings are looked up, whatever their case.
    """
    for path in (field, field.replace("_", ".")):
        column = schema.PATH_COLUMNS.get(path.lower())
        if column in columns:
            return column
    return next((c for c in (snake_name(field), field) if c in columns), None)


def field_columns(columns: Sequence[str]) -> dict[str, str]:
    """Patch field, in lower case, -> column, for all fields that reach a column: a small map for plans."""
    out = {c.lower(): c for c in columns}
    for path, column in schema.PATH_COLUMNS.items():
        if column in columns:
            out |= {path: column, path.replace(".", "_"): column}
            out.setdefault(snake_name(path), column)
    return out


def _target(field: Column, columns: Sequence[str]) -> Column:
    pairs = sorted(field_columns(columns).items())
    found = F.create_map(*[F.lit(x) for p in pairs for x in p])
    low, snake = F.lower(field), F.lower(F.regexp_replace(F.regexp_replace(field, "([a-z0-9])([A-Z])", "$1_$2"), r"\.", "_"))
    return F.coalesce(F.try_element_at(found, low), F.try_element_at(found, snake))


def lived(
    base: DataFrame, updates: DataFrame, key: str = "org_nr", order: Sequence[str] = ("timestamp", "update_id"),
    phase_order: bool = False
) -> DataFrame:
    """``updates`` with alive_before, effective, epoch, and in_base.

    Insertions make an entity, deletions end it, patches reach a living one. ``epoch`` counts an entity's effective
    deletions up to each row. ``phase_order`` applies insertions, patches and deletions in that order.
    """
    kind = F.col("change_type")
    life = F.when(kind.isin(*schema.INSERTED), True).when(kind.isin(*schema.DELETED), False)
    phase = F.when(kind.isin(*schema.INSERTED), 0).when(kind.isin(*schema.DELETED), 2).otherwise(1)
    seq = [phase, *map(F.col, order)] if phase_order else list(map(F.col, order))
    w = W.partitionBy(key).orderBy(*seq)
    members = base.select(key, F.lit(True).alias("in_base")).dropDuplicates([key])
    out = updates.join(members, key, "left").withColumn("in_base", F.coalesce("in_base", F.lit(False))).withColumn("_life", life)
    before = F.coalesce(F.last("_life", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)), F.col("in_base"))
    out = out.withColumn("_seq", F.row_number().over(w)).withColumn("alive_before", before)
    effective = F.when(kind.isin(*schema.INSERTED), ~F.col("alive_before")).when(kind.isin(*schema.DELETED, *schema.CHANGED), F.col("alive_before")).otherwise(False)
    out = out.withColumn("effective", effective)
    ended = F.sum(F.when(F.col("effective") & kind.isin(*schema.DELETED), 1).otherwise(0)).over(W.partitionBy(key).orderBy("_seq").rowsBetween(W.unboundedPreceding, 0))
    return out.withColumn("epoch", ended).drop("_life")


def until(updates: DataFrame, target_date, inclusive_day: bool = False) -> DataFrame:
    """Updates up to the midnight that begins ``target_date``, or with ``inclusive_day`` through that day (Q5)."""
    day = F.lit(target_date).cast("timestamp")
    stamp = F.col("timestamp").cast("timestamp")
    return updates.where(stamp < day + F.expr("INTERVAL 1 DAY") if inclusive_day else stamp <= day)


def counters(events: DataFrame) -> DataFrame:
    """n_insert, n_update, n_delete of lived() rows that took effect."""
    count = lambda kinds: F.count_if(F.col("effective") & F.col("change_type").isin(*kinds))
    return events.agg(count(schema.INSERTED).alias("n_insert"), count(schema.CHANGED).alias("n_update"), count(schema.DELETED).alias("n_delete"))


def replay(
    base: DataFrame, updates: DataFrame, target_date=None, key: str = "org_nr", inclusive_day: bool = False,
    columns: Sequence[str] | None = None, phase_order: bool = False
) -> DataFrame:
    """The base table as it was at ``target_date`` (C1): one window by key, then the last patch of each field.

    Patches of an entity's last life count; base values only if it never ended. Values are cast to column types.
    ``updates`` has key, update_id, change_type, timestamp and changes (operation, field, new_value). The base's keys
    have to be unique.
    """
    base = base.select(key, *columns) if columns is not None else base
    events = lived(base, until(updates, target_date, inclusive_day) if target_date is not None else updates, key, phase_order=phase_order)
    fields = [c for c in base.columns if c != key]
    final = events.groupBy(key).agg(
        F.max("epoch").alias("_epoch"), F.max_by(F.when(F.col("effective"), ~F.col("change_type").isin(*schema.DELETED)), F.when(F.col("effective"), F.col("_seq"))).alias("_alive")
    )
    patches = events.where(F.col("effective") & ~F.col("change_type").isin(*schema.DELETED))
    patches = patches.select(key, "epoch", "_seq", F.posexplode("changes").alias("_pos", "_patch")).withColumn("_column", _target(F.col("_patch.field"), fields))
    patches = patches.where("_column IS NOT NULL").join(final.select(key, F.col("_epoch")), key).where("epoch = _epoch")
    value = lambda c: F.when(F.col("_column") == c, F.struct(F.col("_patch.new_value").alias("v")))
    at = lambda c: F.when(F.col("_column") == c, F.struct("_seq", "_pos"))
    last = patches.groupBy(key).agg(*[F.max_by(value(c), at(c)).alias(f"_{c}") for c in fields]) if fields else patches.select(key).distinct()
    out = base.withColumn("_in_base", F.lit(True)).join(final, key, "full_outer").join(last, key, "left")
    alive = F.coalesce("_alive", F.col("_in_base"), F.lit(False))
    kept = F.coalesce(F.col("_epoch"), F.lit(0)) == 0
    kinds = dict(base.dtypes)
    new = [F.when(F.col(f"_{c}").isNotNull(), as_type(f"_{c}.v", kinds[c])).otherwise(F.when(kept, F.col(c))).alias(c) for c in fields]
    return out.where(alive).select(key, *new)


def versions(base: DataFrame, updates: DataFrame, key: str = "org_nr", columns: Sequence[str] | None = None) -> DataFrame:
    """Every state that the feed makes of each entity, as rows (key, columns, _from, _to, _alive).

    ``_from`` is NULL for what the base holds, ``_to`` for what still holds; a version is in force from its event on,
    until the next. One pass over the feed: windows by key carry the last patch of each field through an entity's life.
    """
    base = base.select(key, *columns) if columns is not None else base
    fields, kinds = [c for c in base.columns if c != key], dict(base.dtypes)
    events = lived(base, updates.where("timestamp IS NOT NULL"), key).where("effective")
    dead = F.col("change_type").isin(*schema.DELETED)
    # the last patch of each field in an event
    last = lambda c: F.element_at(F.filter("_patches", lambda p: p.column == c), -1)
    named = F.transform(F.coalesce("changes", F.array()), lambda p: F.struct(_target(p.field, fields).alias("column"), p.new_value.alias("v")))
    rows = events.withColumn("_patches", F.when(~dead, F.filter(named, lambda p: p.column.isNotNull())).otherwise(F.array().cast("array<struct<column: string, v: string>>")))
    value = lambda c: F.when(F.size(F.filter("_patches", lambda p: p.column == c)) > 0, F.struct(last(c).v.alias("v")))
    # a row for the base at the beginning of its first life
    start = base.select(key, *[F.col(c).alias(f"_b_{c}") for c in fields], F.lit(0).cast("int").alias("_seq"), F.lit(0).cast("long").alias("epoch"), F.lit(True).alias("_alive"))
    rows = rows.select(key, "timestamp", "_seq", "epoch", (~dead).alias("_alive"), *[value(c).alias(f"_p_{c}") for c in fields])
    rows = rows.unionByName(start, allowMissingColumns=True)
    life, along = W.partitionBy(key, "epoch").orderBy("_seq").rowsBetween(W.unboundedPreceding, 0), W.partitionBy(key).orderBy("_seq")
    held = lambda c: F.last(f"_p_{c}", ignorenulls=True).over(life)
    own = lambda c: F.first(f"_b_{c}").over(life)
    rows = rows.select(
        key, *[F.when(held(c).isNotNull(), as_type(held(c).v, kinds[c])).otherwise(own(c)).alias(c) for c in fields],
        F.col("timestamp").cast("timestamp").alias("_from"), F.lead(F.col("timestamp").cast("timestamp")).over(along).alias("_to"), "_alive",
    )
    # versions that the next event overtakes at once were never in force
    return rows.where("_to IS NULL OR _from IS NULL OR _from < _to")


def replay_dates(
    base: DataFrame, updates: DataFrame, dates: Sequence, key: str = "org_nr", inclusive_day: bool = False,
    columns: Sequence[str] | None = None
) -> DataFrame:
    """replay() at each of ``dates``, with ``target_date``, in one pass over the feed.

    A version of an entity goes to the dates between its event and the next: no join, and an entity that never
    changes is one row until the end.
    """
    days = F.array(*[F.lit(d).cast("date") for d in sorted(set(map(str, dates)))])
    at = lambda d: (d + F.expr("INTERVAL 1 DAY")).cast("timestamp") if inclusive_day else d.cast("timestamp")
    begun = lambda d: F.col("_from").isNull() | ((F.col("_from") < at(d)) if inclusive_day else (F.col("_from") <= at(d)))
    ended = lambda d: F.col("_to").isNotNull() & ((F.col("_to") < at(d)) if inclusive_day else (F.col("_to") <= at(d)))
    rows = versions(base, updates, key, columns).where("_alive")
    in_force = F.filter(days, lambda d: begun(d) & ~ended(d))
    return rows.withColumn("target_date", F.explode(in_force)).drop("_from", "_to", "_alive")


def change_rows(
    base: DataFrame, updates: DataFrame, key: str = "org_nr", registry: str = "enheter",
    order: Sequence[str] = ("timestamp", "update_id"), phase_order: bool = False
) -> DataFrame:
    """Changelog rows that applying ``updates`` to ``base`` writes.

    Insertions give an entry and deletions an exit each, whether known or not. A patch gives a change with the value
    before it: that of the last patch to the field in this life, else the base's. Unless it removes, a patch that
    changes nothing is left out, as are patches to unknown entities and fields.
    """
    events = lived(base, updates, key, order, phase_order)
    none, kind = F.lit(None).cast("string"), F.col("change_type")
    meta = [F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col(key), F.lit(registry).alias("registry")]
    moved = events.where(kind.isin(*schema.INSERTED, *schema.DELETED)).select(
        *meta, F.when(kind.isin(*schema.INSERTED), "entry").otherwise("exit").alias("change_type"), none.alias("field"), none.alias("value_from"), none.alias("value_to"), "update_id"
    )
    fields, kinds = [c for c in base.columns if c != key], dict(base.dtypes)
    patched = events.where(F.col("effective") & ~kind.isin(*schema.DELETED))
    patched = patched.select(*meta, "update_id", kind.alias("_kind"), "epoch", "_seq", F.posexplode("changes").alias("_pos", "_patch"))
    patched = patched.withColumn("field", _target(F.col("_patch.field"), fields)).where("field IS NOT NULL")
    origin = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[shown(c, kinds[c]) for c in fields]))
    patched = patched.join(base.select(key, origin.alias("_origin")), key, "left")
    w = W.partitionBy(key, "field", "epoch").orderBy("_seq", "_pos")
    remove = F.lower(F.col("_patch.operation")) == "remove"
    to = F.when(remove, none).otherwise(F.col("_patch.new_value"))
    first = F.row_number().over(w) == 1
    before = F.when(first, F.when(F.col("epoch") == 0, F.try_element_at("_origin", F.col("field")))).otherwise(F.lag(to).over(w))
    patched = patched.withColumns({"value_from": before, "value_to": to, "_first": first})
    changed = patched.where(F.col("_kind").isin(*schema.CHANGED)).where(remove | ~F.col("value_from").eqNullSafe(F.col("value_to")))
    out = ["timestamp", key, "registry", "change_type", "field", "value_from", "value_to", "update_id"]
    return moved.select(*out).unionByName(changed.withColumn("change_type", F.lit("change")).select(*out))


def latest_per_key(events: DataFrame, key: str = "org_nr") -> DataFrame:
    """(key, timestamp, update_id): the last of each entity's events."""
    return events.groupBy(key).agg(F.max("timestamp").alias("timestamp"), F.max("update_id").alias("update_id"))
