"""Change feeds: events, their patches flattened, and cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import PATCHES
from ..functions.types import LONG, STRING, fields, struct

#: An event of the entity feed; patches stay text, since their values are of any shape.
EVENT = fields("oppdateringsid long, organisasjonsnummer string, endringstype string, dato string, endringer string")
#: An event of the role feed.
ROLE_EVENT = struct(id=LONG, type=STRING, time=STRING, data=struct(organisasjonsnummer=STRING))


#: Levels of a patch's value that are told apart; what lies deeper stays one value, as JSON text.
LEVELS = 6
_LEAF = "array<struct<field: string, value: variant>>"


def _deeper(leaves: Column) -> Column:
    """(field, value) leaves one level down: members of objects by name, items of arrays by number from 0."""

    def one(leaf: Column) -> Column:
        members, items = leaf.value.try_cast("map<string,variant>"), leaf.value.try_cast("array<variant>")
        named = F.transform(F.map_entries(members), lambda e: F.struct(F.concat(leaf.field, F.lit("_"), e.key).alias("field"), e.value.alias("value")))
        numbered = F.transform(items, lambda x, i: F.struct(F.concat(leaf.field, F.lit("_"), i.cast("string")).alias("field"), x.alias("value")))
        return F.coalesce(named, numbered, F.array(leaf))

    return F.flatten(F.transform(leaves, one))


def _name(path: Column) -> Column:
    return F.translate(F.trim(F.coalesce(path, F.lit("")), F.lit("/")), "/", "_")


def patches(text: Column, levels: int = LEVELS) -> Column:
    """Patches of an event, a JSON array, as rows (operation, field, new_value), level by level as VARIANT.

    A removal or NULL has no value; a move also removes where it came from; an empty array, which clears, is a NULL.
    Of an object or array each leaf is a row, objects' members in the order of their names; inner ones that are empty
    have none. NULL and what is no JSON array have no patches.
    """
    row = lambda op, field, value: F.struct(op.alias("operation"), field.alias("field"), value.alias("new_value"))
    none, get = F.lit(None).cast("string"), lambda p, key, kind: F.try_variant_get(p, f"$.{key}", kind)

    def shown(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        return F.when(kind == "BOOLEAN", F.upper(v.try_cast("string"))).when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(v)).otherwise(v.try_cast("string"))

    def one(p: Column) -> Column:
        op, field, value = get(p, "op", "string"), _name(get(p, "path", "string")), get(p, "value", "variant")
        leaves = F.array(F.struct(field.alias("field"), value.alias("value"))).cast(_LEAF)
        for _ in range(levels):
            leaves = _deeper(leaves)
        # one nesting of its own, so that the leaves are computed once
        told = F.flatten(F.transform(F.array(leaves), lambda found: F.transform(found, lambda x: row(op, x.field, shown(x.value)))))
        plain = F.array(row(op, field, none))
        moved = F.array(row(F.lit("remove"), _name(get(p, "from", "string")), none), row(op, field, none))
        cleared = (op == "remove") | F.coalesce(F.size(value.try_cast("array<variant>")) == 0, F.lit(False))
        return F.when(op == "move", moved).when((op == "copy") | cleared, plain).otherwise(told)

    found = F.try_parse_json(text).try_cast("array<variant>")
    return F.coalesce(F.flatten(F.transform(found, one)), F.array()).cast(PATCHES)


def events(raw: DataFrame, include_changes: bool = True) -> DataFrame:
    """(update_id, org_nr, change_type, timestamp [, changes]) of feed rows (S12, P13); times are UTC."""
    stamp = F.try_to_timestamp(F.regexp_replace(F.substring("dato", 1, 19), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))
    columns = [F.col("oppdateringsid").alias("update_id"), F.col("organisasjonsnummer").alias("org_nr"), F.col("endringstype").alias("change_type"), stamp.alias("timestamp")]
    return raw.select(*columns, *([patches(F.col("endringer")).alias("changes")] if include_changes else []))


def role_events(raw: DataFrame) -> DataFrame:
    """The same of the role feed (S13): the kind is the last part of the event's type."""
    stamp = F.try_to_timestamp(F.regexp_replace(F.substring("time", 1, 19), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))
    return raw.select(F.col("id").alias("update_id"), F.col("data.organisasjonsnummer").alias("org_nr"), F.regexp_replace("type", r"^.*\.", "").alias("change_type"), stamp.alias("timestamp"))


def update_fields(feed: DataFrame) -> DataFrame:
    """One row for each patch (S14); an event without patches keeps a row."""
    rows = feed.withColumn("_p", F.explode_outer("changes"))
    return rows.select("update_id", "org_nr", "change_type", "timestamp", F.col("_p.operation").alias("operation"), F.col("_p.field").alias("field"), F.col("_p.new_value").alias("new_value"))


def read_pages(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int = 5, schema: T.StructType = EVENT) -> DataFrame:
    """Stored pages of a feed as JSON lines, in batch or as a stream of at most so many files a batch."""
    if streaming:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    return spark.read.schema(schema).json(path)


def after_cursor(feed: DataFrame, cursor: int, size: int | None = None) -> DataFrame:
    """Events past a cursor, in order, at most ``size``."""
    out = feed.where(F.col("update_id") > cursor).orderBy("update_id")
    return out if size is None else out.limit(size)


def tip(feed: DataFrame) -> int:
    """The last id of a feed, 0 for an empty one."""
    return feed.agg(F.coalesce(F.max("update_id"), F.lit(0))).first()[0]
