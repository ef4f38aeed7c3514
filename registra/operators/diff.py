"""Keyed differences of two states, as long rows: snapshots (D1) and roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import schema
from ..functions.exprs import shown


def _kinds(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a stated order."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def _told(pair: str, *names: str) -> list[Column]:
    """The texts of an exploded array by name."""
    return [F.col(pair)[i].alias(n) for i, n in enumerate(names)]


def _differences(both: DataFrame, columns: Sequence[str], kinds: tuple[dict, dict]) -> DataFrame:
    """A row with ``_pair`` [field, value_from, value_to] for each column in which ``old`` and ``new`` differ as text.

    No filter before the explode, which the optimizer would multiply where one side is empty; and plain columns and arrays
    of texts, no structs: where fields of structs meet an explode, Spark's pruning of them, as
    a mere count of the rows asks for it, copies expressions until memory ends.
    """
    text = lambda side, c: F.col(f"_{side}_{c}").cast("string")
    differ = {c: ~text("old", c).eqNullSafe(text("new", c)) for c in columns}
    if not differ:
        return both.where("false").withColumn("_pair", F.lit(None).cast("array<string>"))
    pairs = [F.when(differ[c], F.array(F.lit(c), shown(f"_old_{c}", kinds[0][c]), shown(f"_new_{c}", kinds[1][c]))) for c in columns]
    return both.withColumn("_pair", F.explode(F.array(*pairs))).where("_pair IS NOT NULL")


def _joined(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One full outer join on the keys: ``_old_`` and ``_new_`` columns, ``_in_old`` and ``_in_new`` where a side has a row."""
    side = lambda df, name: df.select(*keys, F.lit(True).alias(f"_in_{name}"), *[F.col(c).alias(f"_{name}_{c}") for c in columns])
    return side(old, "old").join(side(new, "new"), list(keys), "full_outer")


def snapshot_events(old: DataFrame, new: DataFrame, event_date, columns: Sequence[str] | None = None, key: str = "org_nr") -> DataFrame:
    """Entries, exits and changed fields between two snapshots.

    (key, event_type, event_date, field, value_from, value_to); entries and exits have no field. Tracked are
    ``columns``, or those of both snapshots. Values are compared as typed, NULL transitions count, and are shown as
    text. Keys have to be unique in each snapshot.
    """
    common = [c for c in (columns or old.columns) if c in old.columns and c in new.columns and c != key]
    both = _joined(old, new, [key], common).withColumn("event_date", F.lit(event_date).cast("date"))
    none = F.lit(None).cast("string")
    gone = F.col("_in_new").isNull() | F.col("_in_old").isNull()
    moved = both.where(gone).select(
        key, F.when(F.col("_in_old").isNull(), "entry").otherwise("exit").alias("event_type"), "event_date",
        none.alias("field"), none.alias("value_from"), none.alias("value_to"),
    )
    changed = _differences(both.where(~gone), common, (_kinds(old), _kinds(new)))
    return moved.unionByName(changed.select(key, F.lit("change").alias("event_type"), "event_date", *_told("_pair", "field", "value_from", "value_to")))


def role_key(roles: DataFrame, order: Sequence[str] = ("ordering", "last_name", "first_name", "entity_name")) -> DataFrame:
    """``roles`` with holder_id and role_key (P15): org, group, role and holder, NULL parts printed as NA.

    A holder is a person, else an entity, else unknown by its place among all unknown ones of the organisation.
    """
    # all other columns break ties, so two reads of one extract number alike
    rest = [c for c in sorted(roles.columns) if c not in order]
    nobody = F.col("person_id").isNull() & F.col("entity_org_nr").isNull()
    place = W.partitionBy("org_nr", nobody).orderBy(*[F.col(c) for c in [*order, *rest] if c in roles.columns])
    unknown = F.row_number().over(place).cast("string")
    holder = F.coalesce(F.col("person_id"), F.concat(F.lit("entity:"), F.col("entity_org_nr")), F.concat(F.lit("unknown:"), unknown))
    part = lambda c: F.coalesce(F.col(c), F.lit("NA"))
    keyed = roles.withColumn("holder_id", holder)
    return keyed.withColumn("role_key", F.concat_ws("|", part("org_nr"), part("role_group_code"), part("role_code"), "holder_id"))


def backfill_roles(roles: DataFrame) -> DataFrame:
    """Older role states with the columns they lack, typed and NULL."""
    missing = [f for f in schema.ROLES if f.name not in roles.columns]
    return roles.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else roles


_NOBODY = "person_id IS NULL AND entity_org_nr IS NULL"


def _part(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("NA"))


def _changelog(pairs: DataFrame, timestamp: str, update_id: int | None) -> DataFrame:
    """Changelog rows of (org_nr, role_key, kind, field, value_from, value_to) where the values differ."""
    return pairs.where("NOT value_from <=> value_to").select(
        F.lit(timestamp).alias("timestamp"), "org_nr", F.lit("roller").alias("registry"), F.col("kind").alias("change_type"), "field", "value_from", "value_to",
        F.lit(update_id).cast("long").alias("update_id"), "role_key",
    )


def _unknown_changes(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Entries and exits of holders without person or entity: how many more or fewer there are of each kind alike.

    They go by all columns, so one that both extracts have is the same, and its key is the same in every extract.
    """
    every = sorted(f.name for f in schema.ROLES)
    alike = F.substring(F.md5(F.to_json(F.struct(*every)).cast("binary")), 1, 16)
    key = F.concat_ws("|", _part("org_nr"), _part("role_group_code"), _part("role_code"), F.concat(F.lit("unknown:"), alike))
    side = lambda df, sign: df.where(_NOBODY).select(*every, F.lit(sign).alias("_sign"))
    more = side(old, -1).unionByName(side(new, 1)).groupBy(*every).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_more")))
    rows = more.select("*", key.alias("role_key"), F.when(F.col("_more") > 0, "entry").otherwise("exit").alias("kind"), times.alias("_each"))
    kinds, none = _kinds(rows), F.lit(None).cast("string")
    pairs = F.explode(F.array(*[F.array(F.lit(c), shown(c, kinds[c])) for c in columns]))
    rows = rows.select("org_nr", "role_key", "kind", pairs.alias("_p")).select("org_nr", "role_key", "kind", *_told("_p", "field", "v"))
    left, entered = F.when(F.col("kind") == "exit", F.col("v")).otherwise(none), F.when(F.col("kind") == "entry", F.col("v")).otherwise(none)
    return rows.select("org_nr", "role_key", "kind", "field", left.alias("value_from"), entered.alias("value_to"))


def role_changes(
    old: DataFrame | None, new: DataFrame, timestamp: str, update_id: int | None = None,
    columns: Sequence[str] = schema.ROLE_VALUES, order: Sequence[str] = ("ordering",)
) -> DataFrame:
    """Role differences as changelog rows (D2-D4, J8), with role_key so that a change tells whose role it is.

    Entries and exits give a row for each value there is, changes one for each value that differs. Of rows with one
    key the first in ``order`` counts. Holders without person or entity are matched as a multiset, by all they are told
    to be: those that both extracts have are the same, each more is an entry, each fewer an exit (P15, W4). No old
    state, or an empty one, makes all roles entries.
    """
    new = backfill_roles(new)
    old = backfill_roles(old) if old is not None else new.where("false")
    holder = F.coalesce("person_id", F.concat(F.lit("entity:"), F.col("entity_org_nr")))
    key = F.concat_ws("|", _part("org_nr"), _part("role_group_code"), _part("role_code"), holder)
    # a key tells its organisation, so first rows lie where the join wants them
    keyed = lambda df: first_rows(df.where(f"NOT ({_NOBODY})").withColumn("role_key", key), ["role_key", "org_nr"], [F.col(c).asc_nulls_last() for c in order])
    known_old, known_new = keyed(old), keyed(new)
    both = _joined(known_old, known_new, ["role_key", "org_nr"], list(columns))
    pairs = _differences(both, columns, (_kinds(known_old), _kinds(known_new)))
    kind = F.when(F.col("_in_old").isNull(), "entry").when(F.col("_in_new").isNull(), "exit").otherwise("change")
    pairs = pairs.select("org_nr", "role_key", kind.alias("kind"), *_told("_pair", "field", "value_from", "value_to")).unionByName(_unknown_changes(old, new, columns))
    return _changelog(pairs, timestamp, update_id)


def rows_update(left: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``left`` with ``columns`` taken from the matching row of ``updates`` where there is one."""
    side = updates.select(key, F.struct(*columns).alias("_new"))
    joined = left.join(side, key, "left")
    return joined.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns])
