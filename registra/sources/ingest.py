"""From nested JSON and CSV to flat, typed tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dictionaries, schema
from ..functions.exprs import as_type, person_id, snake_name
from ..functions.types import BOOLEAN, INT, STRING, array, struct
from . import ranges


def read_csv(spark: SparkSession, path: str, n_max: int | None = None, range_bytes: int | None = None) -> DataFrame:
    """A bulk CSV (S9): commas, UTF-8, quoted line breaks, every column a text.

    Quoted line breaks make a file one task, unless it is read in ranges of ``range_bytes``, which needs files that are
    not compressed and quote as RFC 4180 has it.
    """
    if range_bytes is None:
        out = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    else:
        rows = ranges.records(spark, path, False, range_bytes)
        out = rows.select(F.from_csv("value", ", ".join(f"`{c.replace('`', '``')}` string" for c in ranges.header(path)), {"escape": '"'}).alias("r")).select("r.*")
    return out if n_max is None else out.limit(n_max)


def read_json(
    spark: SparkSession, path: str, kind: T.StructType | None = None, lines: bool = False,
    range_bytes: int | None = None
) -> DataFrame:
    """A bulk JSON array, which one task reads unless it is read in ranges of ``range_bytes``, or JSON lines.

    In ranges, a schema that isn't given is found from all elements, once, before.
    """
    if range_bytes is not None and not lines:
        rows = ranges.records(spark, path, True, range_bytes)
        if kind is None:
            found = rows.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
            kind = T.StructType.fromDDL(re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT\b(<>)?", lambda m: "STRING" if m[1] else "STRUCT", found)).removeprefix("STRUCT<").removesuffix(">"))
        return rows.select(F.from_json("value", kind).alias("r")).select("r.*")
    reader = spark.read.option("multiLine", not lines)
    return (reader if kind is None else reader.schema(kind)).json(path)


def flat_leaves(kind: T.StructType, path: str = "") -> list[tuple[str, T.DataType]]:
    """(path, type) of what a nested row flattens to: structs are walked, links left out."""
    out = []
    for f in kind:
        name = f"{path}.{f.name}" if path else f.name
        if re.search(r"\.?_?links$", name):
            continue
        out += flat_leaves(f.dataType, name) if isinstance(f.dataType, T.StructType) else [(name, f.dataType)]
    return out


def cell(c: Column, kind: T.DataType) -> Column:
    """A value as one cell (P3): arrays of plain values joined by "; ", other nested values as JSON, empty ones NULL."""
    if isinstance(kind, T.ArrayType):
        nested = isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType))
        joined = F.to_json(c) if nested else F.array_join(F.transform(c, lambda x: x.cast("string")), "; ")
        return F.when(F.size(c) > 0, joined)
    return F.to_json(c) if isinstance(kind, (T.StructType, T.MapType)) else c


def _path(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def flatten(raw: DataFrame) -> DataFrame:
    """Nested rows as flat ones with dotted names."""
    return raw.select(*[cell(_path(p), k).alias(p) for p, k in flat_leaves(raw.schema)])


def tidy(flat: DataFrame) -> DataFrame:
    """Dictionary columns, typed and all there, then unknown ones in snake case.

    Paths are matched whatever their case. Two spellings of one column are combined. What can't be read is NULL.
    """
    found: dict[str, list[str]] = {}
    other: dict[str, str] = {}
    for name in flat.columns:
        if re.search(r"\.?_?links$", name):
            continue
        column = schema.PATH_COLUMNS.get(name.lower())
        if column:
            found.setdefault(column, []).append(name)
        else:
            other.setdefault(snake_name(name), name)
    quoted = lambda n: F.col(f"`{n}`")
    typed = []
    for column, kind in schema.COLUMN_TYPES.items():
        sources = [quoted(n) for n in found.get(column, [])]
        value = F.coalesce(*sources) if len(sources) > 1 else (sources[0] if sources else F.lit(None))
        typed.append((as_type(value.cast("string"), kind) if sources else value.cast(kind)).alias(column))
    return flat.select(*typed, *[quoted(n).alias(c) for c, n in other.items() if c not in schema.COLUMN_TYPES])


def parse_problems(flat: DataFrame, most: int = 20, key: str | None = None) -> DataFrame:
    """(column, row, expected, actual): values of dictionary columns that can't be read, ``most`` for each (P5).

    Rows are told by ``key``, or else by their order in the file's partitions; the first ones of a column are reported.
    """
    numbered = flat.withColumn("_row", F.monotonically_increasing_id() if key is None else F.col(key).cast("long"))
    pairs = []
    for name in flat.columns:
        column = schema.PATH_COLUMNS.get(name.lower())
        kind = schema.COLUMN_TYPES.get(column or "", "string")
        if kind != "string":
            raw = F.col(f"`{name}`").cast("string")
            bad = raw.isNotNull() & (raw != "") & as_type(raw, kind).isNull()
            pairs.append(F.when(bad, F.struct(F.lit(column).alias("column"), F.lit(kind).alias("expected"), raw.alias("actual"))))
    if not pairs:
        return flat.sparkSession.createDataFrame([], "column string, row long, expected string, actual string")
    rows = numbered.select("_row", F.explode(F.array_compact(F.array(*pairs))).alias("p"))
    rank = F.row_number().over(W.partitionBy("p.column").orderBy("_row"))
    rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= most)
    return rows.select("p.column", F.col("_row").alias("row"), "p.expected", "p.actual")


def parse_entities(raw: DataFrame) -> DataFrame:
    """Nested entities as the entity table."""
    return tidy(flatten(raw))


#: Shape of the roles extract: entities with groups of roles.
ROLE_INPUT = struct(
    organisasjonsnummer=STRING,
    rollegrupper=array(struct(
        type=struct(kode=STRING, beskrivelse=STRING), sistEndret=STRING,
        roller=array(struct(
            type=struct(kode=STRING, beskrivelse=STRING),
            person=struct(fodselsdato=STRING, navn=struct(fornavn=STRING, mellomnavn=STRING, etternavn=STRING), erDoed=BOOLEAN),
            enhet=struct(organisasjonsnummer=STRING, navn=array(STRING)),
            fratraadt=BOOLEAN, avregistrert=BOOLEAN, rekkefolge=INT, valgtAv=struct(kode=STRING),
        )),
    )),
)


def _mapped(codes: dict[str, str], c: Column) -> Column:
    found = F.create_map(*[F.lit(x) for p in codes.items() for x in p])
    return F.coalesce(F.try_element_at(found, c), c)


def flatten_roles(raw: DataFrame, order_column: str | None = None) -> DataFrame:
    """Nested entities as the role table (P7, P10): a row for each role of each group; groups without roles vanish."""
    group = raw.select(F.col("organisasjonsnummer").alias("org_nr"), F.explode("rollegrupper").alias("g"))
    role = group.select("org_nr", "g", F.explode("g.roller").alias("r"))
    first, middle, last, born = (F.col(f"r.person.{p}") for p in ("navn.fornavn", "navn.mellomnavn", "navn.etternavn", "fodselsdato"))
    birth = as_type(born, "date")
    names = {k: v[0] for k, v in dictionaries.ROLE_TYPES.items()}, {k: v[0] for k, v in dictionaries.ROLE_GROUPS.items()}
    return role.select(
        "org_nr", F.col("g.type.kode").alias("role_group_code"), _mapped(names[1], F.col("g.type.kode")).alias("role_group"),
        F.col("r.type.kode").alias("role_code"), _mapped(names[0], F.col("r.type.kode")).alias("role"),
        first.alias("first_name"), middle.alias("middle_name"), last.alias("last_name"), birth.alias("birth_date"), F.col("r.person.erDoed").alias("deceased"),
        F.col("r.enhet.organisasjonsnummer").alias("entity_org_nr"), entity_name(F.col("r.enhet.navn"), role.select("r.enhet.navn").schema[0].dataType).alias("entity_name"),
        F.coalesce("r.fratraadt", F.lit(False)).alias("resigned"), F.col("r.avregistrert").alias("deregistered"), F.col("r.rekkefolge").alias("ordering"),
        F.col("r.valgtAv.kode").alias("elected_by"), as_type("g.sistEndret", "date").alias("group_modified"), person_id(birth, last, first, middle).alias("person_id"),
    )


def entity_name(c: Column, kind: T.DataType) -> Column:
    """A name given as text, as parts or as an object with its first line."""
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(c) > 0, F.array_join(c, " "))
    return c.getField("navnelinje1") if isinstance(kind, T.StructType) else c


#: Shape of an answer on signing rights or procuration.
SIGNING_INPUT = struct(
    organisasjonsnummer=STRING, enhet=struct(navn=STRING), status=struct(regelStatus=struct(kode=STRING)),
    signeringsGrunnlag=struct(signaturProkuraRoller=struct(signaturProkuraFritekst=STRING)),
    signeringsKombinasjon=struct(kombinasjon=array(struct(
        kombinasjonsId=STRING, kode=STRING, tekstforklaring=STRING,
        personRolleKombinasjon=array(struct(navn=STRING, fodselsdato=STRING, rolle=struct(kode=STRING))),
    ))),
)


def flatten_signing(raw: DataFrame, signature_type: str) -> DataFrame:
    """Combinations by persons (P9, S7); one without persons keeps a row, dates are read as dd.mm.yyyy."""
    combos = raw.select("*", F.explode("signeringsKombinasjon.kombinasjon").alias("k"))
    rows = combos.select("*", F.explode_outer("k.personRolleKombinasjon").alias("p"))
    code = F.col("p.rolle.kode")
    return rows.select(
        F.col("organisasjonsnummer").alias("org_nr"), F.col("enhet.navn").alias("entity_name"), F.lit(signature_type).alias("signature_type"),
        F.col("status.regelStatus.kode").alias("rule_status"), F.col("signeringsGrunnlag.signaturProkuraRoller.signaturProkuraFritekst").alias("rule_text"),
        F.col("k.kombinasjonsId").alias("combination_id"), F.col("k.kode").alias("combination_code"), F.col("k.tekstforklaring").alias("rule"),
        F.col("p.navn").alias("name"), F.try_to_date("p.fodselsdato", "dd.MM.yyyy").alias("birth_date"), code.alias("role_code"),
        _mapped({k: v[0] for k, v in dictionaries.ROLE_TYPES.items()}, code).alias("role"),
    )
