"""Registered queries that go by way of files: bulk extracts, feeds, the store and the mirror.

Each writes the driver's tables in the source's own shape to a new folder under the session's shared folder, and
reads them again through the library.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries
from ..operators import changes, diff
from ..sources import buckets, ingest, paging, updates
from ..sources.store import Store
from ..streaming import sync
from . import adapters as A
from .registry import ORACLE_SQL, register


def folder(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset, a temporary one, but never on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    shared = shared or "file://" + tempfile.mkdtemp(prefix="registra-")
    return f"{shared.rstrip('/')}/registra-files/{label}-{uuid.uuid4().hex}"


# bulk files


def _nested_entities(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    return A.entities(spark, sf).select(
        F.col("org_nr").alias("organisasjonsnummer"), F.col("name").alias("navn"), F.struct(F.col("legal_form").alias("kode")).alias("organisasjonsform"),
        text("founding_date").alias("stiftelsesdato"), text("registration_date").alias("registreringsdatoEnhetsregisteret"),
        F.col("employees").alias("antallAnsatte"), F.col("bankrupt").alias("konkurs"), text("bankruptcy_date").alias("konkursdato"),
        F.struct(F.col("municipality_code").alias("kommunenummer"), F.array(F.concat(F.lit("Street "), "org_nr"), F.col("legal_form")).alias("adresse")).alias("forretningsadresse"),
        F.col("parent_org_nr").alias("overordnetEnhet"), F.struct(F.struct(F.lit("https://example.org").alias("href")).alias("self")).alias("_links"),
        F.col("name").alias("ukjentFelt"),
    )


_ENTITY = "org_nr, name, legal_form, founding_date, registration_date, employees, bankrupt, bankruptcy_date, municipality_code, parent_org_nr"
_PARSED = [*_ENTITY.split(", "), "business_address"]


@register(f"SELECT {_ENTITY}, concat('Street ', org_nr, '; ', legal_form) AS business_address, name AS ukjent_felt FROM entities", A.ENTITIES)
def bulk_json_entities(spark, sf):
    """S10, P1, P2, P4"""
    path = folder(spark, "entities")
    _nested_entities(spark, sf).write.json(path)
    return ingest.parse_entities(ingest.read_json(spark, path, lines=True)).select(*_PARSED, "ukjent_felt")


def _written_csv(spark: SparkSession, sf: str) -> str:
    path = folder(spark, "entities-csv")
    flat = ingest.flatten(_nested_entities(spark, sf))
    flat = flat.withColumn("forretningsadresse.adresse", F.concat(F.lit('A "quoted"\nstreet, '), "organisasjonsnummer"))
    flat.write.option("header", True).option("escape", '"').csv(path)
    return path


_CSV = f"SELECT {_ENTITY}, concat('A \"quoted\"', chr(10), 'street, ', org_nr) AS business_address FROM entities"


@register(_CSV, A.ENTITIES)
def bulk_csv_entities(spark, sf):
    """Quoted commas, quotes and line breaks"""
    return ingest.tidy(ingest.read_csv(spark, _written_csv(spark, sf))).select(*_PARSED)


@register(_CSV, A.ENTITIES)
def csv_in_ranges(spark, sf):
    """The same files, read in ranges; small neighbouring ones share tasks"""
    return ingest.tidy(ingest.read_csv(spark, _written_csv(spark, sf), range_bytes=50_000)).select(*_PARSED)


@register(f"SELECT {_ENTITY}, concat('Street ', org_nr, '; ', legal_form) AS business_address, name AS ukjent_felt FROM entities", A.ENTITIES)
def json_array_in_ranges(spark, sf):
    """JSON arrays, read in ranges; small neighbouring ones share tasks"""
    path = folder(spark, "arrays")
    rows = _nested_entities(spark, sf).select(F.to_json(F.struct("*")).alias("value"), F.col("organisasjonsnummer").substr(-2, 2).alias("part"))
    rows.groupBy("part").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value")).select("value").write.text(path)
    return ingest.parse_entities(ingest.read_json(spark, path, range_bytes=5_000)).select(*_PARSED, "ukjent_felt")


@register(_CSV, A.ENTITIES)
def import_csv(spark, sf):
    """K2, K3, K9: a file becomes a dated snapshot"""
    store = Store(spark, folder(spark, "import"))
    path = _written_csv(spark, sf)
    store.import_file(path, "enheter", "2024-01-31")
    store.import_file(path, "enheter", "2024-01-31")
    return store.latest("enheter").select(*_PARSED)


def nested_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Role rows nested as the extract has them."""
    r = A.roles(spark, sf, by_org=True)
    name = F.struct(F.col("first_name").alias("fornavn"), F.col("middle_name").alias("mellomnavn"), F.col("last_name").alias("etternavn"))
    person = F.struct(F.col("birth_date").cast("string").alias("fodselsdato"), name.alias("navn"), F.col("deceased").alias("erDoed"))
    unit = F.struct(F.col("entity_org_nr").alias("organisasjonsnummer"), F.array("entity_name").alias("navn"))
    role = F.struct(
        F.struct(F.col("role_code").alias("kode")).alias("type"), F.when(F.col("person_id").isNotNull(), person).alias("person"),
        F.when(F.col("entity_org_nr").isNotNull(), unit).alias("enhet"), F.col("resigned").alias("fratraadt"), F.col("deregistered").alias("avregistrert"),
        F.col("ordering").alias("rekkefolge"), F.struct(F.col("elected_by").alias("kode")).alias("valgtAv"),
    )
    groups = r.groupBy("org_nr", "role_group_code").agg(F.collect_list(role).alias("roller"))
    group = F.struct(F.struct(F.col("role_group_code").alias("kode")).alias("type"), F.lit(None).cast("string").alias("sistEndret"), "roller")
    return groups.groupBy(F.col("org_nr").alias("organisasjonsnummer")).agg(F.collect_list(group).alias("rollegrupper"))


def _case(column: str, codes: dict[str, tuple[str, str]]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v[0].replace(chr(39), chr(39) * 2)}'" for k, v in codes.items()) + f" ELSE {column} END"


ROLES_SQL = f"""SELECT org_nr, role_group_code, {_case("role_group_code", dictionaries.ROLE_GROUPS)} AS role_group, role_code, {_case("role_code", dictionaries.ROLE_TYPES)} AS role,
  first_name, middle_name, last_name, birth_date, CASE WHEN person_id IS NOT NULL THEN deceased END AS deceased, entity_org_nr, entity_name, coalesce(resigned, false) AS resigned,
  deregistered, ordering, elected_by, group_modified, person_id FROM roles"""


@register(ROLES_SQL, A.ROLES.format(0))
def roles_flatten(spark, sf):
    """P7, P8, P10"""
    return ingest.flatten_roles(nested_roles(spark, sf))


@register(ROLES_SQL, A.ROLES.format(0))
def bulk_json_roles(spark, sf):
    """S11, P7, P8"""
    path = folder(spark, "roles")
    nested_roles(spark, sf).write.option("compression", "gzip").json(path)
    return ingest.flatten_roles(ingest.read_json(spark, path, ingest.ROLE_INPUT, lines=True))


@register(
    f"""SELECT *, {_case("role_code", dictionaries.ROLE_TYPES)} AS role FROM (
      SELECT CAST(c_custkey AS VARCHAR) AS org_nr, c_name AS entity_name, 'signatur' AS signature_type, 'GYLDIG' AS rule_status, concat('Rule of ', c_name) AS rule_text, '1' AS combination_id,
        c_mktsegment AS combination_code, 'alone' AS rule, concat('P', CAST(c_custkey AS VARCHAR)) AS name, CAST(DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS DATE) AS birth_date, 'LEDE' AS role_code FROM customer
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, 'signatur', 'GYLDIG', concat('Rule of ', c_name), '2', 'NONE', 'nobody', NULL, NULL, NULL FROM customer WHERE c_custkey % 2 = 1)"""
)
def signing_rules(spark, sf):
    """P9, S7"""
    key = F.col("c_custkey").cast("string")
    born = F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")), "dd.MM.yyyy")
    who = F.struct(F.concat(F.lit("P"), key).alias("navn"), born.alias("fodselsdato"), F.struct(F.lit("LEDE").alias("kode")).alias("rolle"))
    combo = lambda n, code, text, people: F.struct(F.lit(n).alias("kombinasjonsId"), code.alias("kode"), F.lit(text).alias("tekstforklaring"), people.alias("personRolleKombinasjon"))
    none = F.when(F.lit(False), F.array(who))
    combos = F.when(F.col("c_custkey") % 2 == 1, F.array(combo("1", F.col("c_mktsegment"), "alone", F.array(who)), combo("2", F.lit("NONE"), "nobody", none)))
    combos = F.coalesce(combos, F.array(combo("1", F.col("c_mktsegment"), "alone", F.array(who))))
    nested = A.table(spark, sf, "customer").select(
        key.alias("organisasjonsnummer"), F.struct(F.col("c_name").alias("navn")).alias("enhet"), F.struct(F.struct(F.lit("GYLDIG").alias("kode")).alias("regelStatus")).alias("status"),
        F.struct(F.struct(F.concat(F.lit("Rule of "), "c_name").alias("signaturProkuraFritekst")).alias("signaturProkuraRoller")).alias("signeringsGrunnlag"),
        F.struct(combos.alias("kombinasjon")).alias("signeringsKombinasjon"),
    )
    path = folder(spark, "signing")
    nested.write.json(path)
    return ingest.flatten_signing(ingest.read_json(spark, path, ingest.SIGNING_INPUT, lines=True), "signatur")


# feeds


def feed_pages(spark: SparkSession, sf: str) -> str:
    """The events as stored pages of the entity feed, patches as text."""
    path = folder(spark, "pages")
    patches = F.concat(
        F.lit('[{"op":"replace","path":"/navn","value":"'), "event_type", F.lit('"},{"op":"add","path":"/forretningsadresse","value":{"poststed":"City '), F.col("user_id").cast("string"),
        F.lit('","adresse":["Road '), F.col("event_id").cast("string"), F.lit('","B"]}},{"op":"remove","path":"/hjemmeside"}'),
        F.when(F.col("event_id") % 5 == 0, ',{"op":"move","from":"/mobil","path":"/telefon"}').otherwise(""), F.lit("]"),
    )
    kind = F.when(F.col("event_type") == "signup", "Ny").when(F.col("event_type") == "error", "Sletting").otherwise("Endring")
    A.table(spark, sf, "events").select(
        F.col("event_id").alias("oppdateringsid"), F.col("user_id").cast("string").alias("organisasjonsnummer"), kind.alias("endringstype"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("dato"), patches.alias("endringer"),
    ).write.json(path)
    return path


_PATCH_ROWS = " UNION ALL ".join(
    f"SELECT update_id, org_nr, change_type, \"timestamp\", '{op}' AS operation, '{field}' AS field, {value} AS new_value FROM cdc{where}"
    for op, field, value, where in (
        ("replace", "navn", "v_name", ""), ("add", "forretningsadresse_poststed", "concat('City ', org_nr)", ""), ("add", "forretningsadresse_adresse_0", "concat('Road ', CAST(update_id AS VARCHAR))", ""),
        ("add", "forretningsadresse_adresse_1", "'B'", ""), ("remove", "hjemmeside", "NULL", ""), ("remove", "mobil", "NULL", " WHERE update_id % 5 = 0"), ("move", "telefon", "NULL", " WHERE update_id % 5 = 0"),
    )
)


@register(f"SELECT update_id, org_nr, change_type, date_trunc('second', \"timestamp\") AS \"timestamp\", operation, field, new_value FROM ({_PATCH_ROWS})", A.CDC)
def feed_patches(spark, sf):
    """Pages read, patches of any depth flattened"""
    feed = updates.events(updates.read_pages(spark, feed_pages(spark, sf)))
    return updates.update_fields(feed).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("SELECT update_id, org_nr, change_type FROM cdc WHERE update_id > 1000 ORDER BY update_id LIMIT 500", A.CDC)
def feed_after_cursor(spark, sf):
    """One page after a cursor"""
    feed = updates.events(updates.read_pages(spark, feed_pages(spark, sf)), include_changes=False)
    return updates.after_cursor(feed, 1000, 500).select("update_id", "org_nr", "change_type")


@register("SELECT update_id, org_nr, change_type FROM cdc WHERE update_id > 1234", A.CDC)
def feed_polled(spark, sf):
    """A stream of polls from within a page, two pages each and 256 a batch, started anew until nothing is left"""
    pages, out = folder(spark, "polled-pages"), folder(spark, "polled")
    events = _entity_events(spark, sf).drop("ts")
    paging.write_pages(events, pages, 2500)
    polled = True
    while polled:
        batches = []
        rows = paging.read_events(spark, pages, 1234, 2, streaming=True, polls=256)
        write = rows.writeStream.foreachBatch(lambda batch, n: (batch.write.mode("overwrite").parquet(f"{out}/rows/batch={n}"), batches.append(n)))
        write.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        polled = bool(batches)
    return updates.events(spark.read.schema(updates.EVENT).parquet(f"{out}/rows"), include_changes=False).select("update_id", "org_nr", "change_type")


@register("SELECT update_id, org_nr, v_name AS change_type, date_trunc('second', \"timestamp\") AS \"timestamp\" FROM cdc", A.CDC)
def role_feed(spark, sf):
    """S13"""
    path = folder(spark, "role-events")
    A.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("no.example.roller."), "event_type").alias("type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("time"),
        F.struct(F.col("user_id").cast("string").alias("organisasjonsnummer")).alias("data"),
    ).write.json(path)
    out = updates.role_events(spark.read.schema(updates.ROLE_EVENT).json(path))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# the store


def _stored(spark: SparkSession, sf: str, label: str) -> Store:
    store, s = Store(spark, folder(spark, label)), A.snapshots(spark, sf)
    for date in A.SNAPSHOT_DATES:
        store.write_snapshot(s.where(F.col("snapshot_date") == F.lit(date).cast("date")).drop("snapshot_date"), "enheter", date, format="parquet")
    return store


@register("SELECT org_nr, snapshot_date, status, priority, orders FROM snapshots", A.SNAPSHOTS)
def store_open(spark, sf):
    """S16, K1, K2, K9"""
    return _stored(spark, sf, "open").open("enheter").select("org_nr", "snapshot_date", "status", "priority", "orders")


@register("SELECT org_nr, status, orders FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots)", A.SNAPSHOTS)
def latest_snapshot(spark, sf):
    """T5, S21, S17"""
    return _stored(spark, sf, "latest").latest("enheter").select("org_nr", "status", "orders")


@register(ORACLE_SQL["snapshot_diff"])
def snapshot_diff_bucketed(spark, sf):
    """Two snapshots that lie in buckets, met without a shuffle; parts with equal digests are not read"""
    paths = [folder(spark, f"bucketed-{d}") for d in A.SNAPSHOT_DATES[1:3]]
    for path, date in zip(paths, A.SNAPSHOT_DATES[1:3]):
        buckets.write_bucketed(A.snapshots(spark, sf).where(F.col("snapshot_date") == F.lit(date).cast("date")).drop("snapshot_date"), path, parts=8, buckets=4)
    return diff.snapshot_events(*buckets.changed_rows(spark, *paths), A.SNAPSHOT_DATES[2])


@register("SELECT DISTINCT snapshot_date, true AS there FROM snapshots WHERE snapshot_date > DATE '1997-06-30'", A.SNAPSHOTS)
def store_retained(spark, sf):
    """What is listed after the oldest went"""
    store = _stored(spark, sf, "retained")
    store.cleanup("enheter", keep_n=len(A.SNAPSHOT_DATES) - 1)
    return store.listing("enheter").select("snapshot_date", (F.col("file_size") > 0).alias("there"))


@register("SELECT concat('enheter-', CAST(snapshot_date AS VARCHAR)) AS id, 'enheter' AS type, CAST(snapshot_date AS VARCHAR) AS snapshot_date, 'parquet' AS format, count(*) AS record_count FROM snapshots GROUP BY snapshot_date", A.SNAPSHOTS)
def store_manifest(spark, sf):
    """S20, K6"""
    return _stored(spark, sf, "manifest").manifest().select("id", "type", "snapshot_date", "format", "record_count")


@register(f"SELECT 'snapshots' AS part, 'enheter' AS kind, {len(A.SNAPSHOT_DATES)} AS entries, count(*) AS rows FROM snapshots UNION ALL SELECT 'changelog', 'all', 0, 0", A.SNAPSHOTS)
def store_status(spark, sf):
    """K10, K11"""
    return _stored(spark, sf, "status").status_table().select("part", F.coalesce("kind", F.lit("all")).alias("kind"), "entries", F.coalesce("rows", F.lit(0)).alias("rows"))


@register("SELECT \"timestamp\", org_nr, registry, change_type, field, value_to, update_id, sync_date FROM changelog WHERE sync_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'", A.CHANGELOG)
def store_changelog(spark, sf):
    """A folder for each batch; a repeated batch overwrites its own"""
    store, log = Store(spark, folder(spark, "log")), A.changelog(spark, sf)
    days = [str(r[0]) for r in log.where("sync_date BETWEEN '2024-01-05' AND '2024-01-20'").select("sync_date").distinct().collect()]
    for n, day in enumerate(days):
        for _ in range(1 + (n == 0)):
            store.write_changelog(log.where(F.col("sync_date") == F.lit(day).cast("date")).drop("sync_date"), day, n)
    return changes.changes(store.changelog(), start="2024-01-05", end="2024-01-20")


# the mirror

#: What the whole feed makes of the base, whatever its length.
ALL_LIVED = """lived AS (SELECT *, CASE change_type WHEN 'Ny' THEN NOT before ELSE before END AS effective FROM (SELECT c.*, coalesce(
    last_value(CASE change_type WHEN 'Ny' THEN true WHEN 'Sletting' THEN false END IGNORE NULLS) OVER (PARTITION BY c.org_nr ORDER BY "timestamp", update_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), b.org_nr IS NOT NULL) AS before
  FROM cdc c LEFT JOIN base b ON b.org_nr = c.org_nr)),
 epochs AS (SELECT *, sum(CASE WHEN effective AND change_type = 'Sletting' THEN 1 ELSE 0 END) OVER (PARTITION BY org_nr ORDER BY "timestamp", update_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM lived),
 final AS (SELECT org_nr, max(epoch) AS last_epoch, arg_max(change_type <> 'Sletting', ("timestamp", update_id)) FILTER (effective) AS alive FROM epochs GROUP BY org_nr)"""


def _entity_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events as the entity feed has them, and ``ts``."""
    feed = A.table(spark, sf, "events")
    patches = F.concat(
        F.lit('[{"op":"replace","path":"/navn","value":"'), "event_type", F.lit('"},{"op":"replace","path":"/antallAnsatte","value":'), F.coalesce(F.get_json_object("props", "$.k"), F.lit("null")), F.lit("}]")
    )
    kind = F.when(F.col("event_type") == "signup", "Ny").when(F.col("event_type") == "error", "Sletting").otherwise("Endring")
    return feed.select(
        F.col("event_id").alias("oppdateringsid"), F.col("user_id").cast("string").alias("organisasjonsnummer"), kind.alias("endringstype"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("dato"), patches.alias("endringer"), "ts",
    )


def mirrored(spark: SparkSession, sf: str) -> Store:
    """A mirror after two runs: the feed's first half by time, then the rest."""
    store, pages = Store(spark, folder(spark, "mirror")), folder(spark, "feed")
    feed, raw = A.table(spark, sf, "events"), _entity_events(spark, sf)
    sync.bootstrap(store, "enheter", A.base(spark, sf))
    middle = feed.agg(F.expr("timestamp_micros(cast((unix_micros(cast(min(ts) as timestamp)) + unix_micros(cast(max(ts) as timestamp))) / 2 as bigint))").alias("t")).first().t
    # seconds are what the feed tells, so the halves part at a whole one
    early = F.date_trunc("second", F.col("ts").cast("timestamp")) <= F.date_trunc("second", F.lit(middle))
    for half in (early, ~early):
        raw.where(half).drop("ts").write.mode("append").json(pages)
        # a run's files are one batch, so that events apply in time order whatever file they are in
        sync.sync(store, "enheter", pages, f"{store.root}/checkpoint-enheter", files_per_batch=1_000_000)
    return store


#: The state that the whole feed leaves, and the changes that lead to it.
_STATE = """SELECT org_nr, CASE WHEN p.seen THEN p.name WHEN coalesce(last_epoch, 0) = 0 THEN b.name END AS name, CASE WHEN p.seen THEN p.employees WHEN coalesce(last_epoch, 0) = 0 THEN b.employees END AS employees
    FROM base b FULL JOIN final USING (org_nr) LEFT JOIN (SELECT e.org_nr, true AS seen, arg_max(v_name, ("timestamp", update_id)) AS name, CAST(arg_max(v_k, ("timestamp", update_id)) AS INTEGER) AS employees
      FROM epochs e JOIN final f ON f.org_nr = e.org_nr AND epoch = last_epoch WHERE effective AND change_type <> 'Sletting' GROUP BY e.org_nr) p USING (org_nr)
    WHERE coalesce(alive, b.org_nr IS NOT NULL)"""
_WHOLE_SECONDS = A.CDC.replace("ts AS \"timestamp\"", "date_trunc('second', ts) AS \"timestamp\"")
_CHANGES = """SELECT strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", org_nr, CASE change_type WHEN 'Ny' THEN 'entry' ELSE 'exit' END AS change_type, NULL AS field, NULL AS value_from, NULL AS value_to, update_id FROM epochs WHERE change_type <> 'Endring'
      UNION ALL SELECT strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), org_nr, 'change', field, value_from, value_to, update_id FROM (
        SELECT *, v AS value_to, CASE WHEN row_number() OVER w = 1 THEN CASE WHEN epoch = 0 THEN origin END ELSE lag(v) OVER w END AS value_from FROM (
          SELECT e.*, 'name' AS field, v_name AS v, b.name AS origin FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting' UNION ALL
          SELECT e.*, 'employees', v_k, CAST(b.employees AS VARCHAR) FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting')
        WINDOW w AS (PARTITION BY org_nr, field, epoch ORDER BY "timestamp", update_id)) WHERE change_type = 'Endring' AND value_from IS DISTINCT FROM value_to"""


@register(_STATE, _WHOLE_SECONDS, ALL_LIVED)
def mirror_state(spark, sf):
    """A stream of pages applied in two runs"""
    return mirrored(spark, sf).state("enheter").select("org_nr", "name", "employees")


@register(
    """SELECT change_type, count(*) AS n FROM (
      SELECT change_type FROM (SELECT CASE change_type WHEN 'Ny' THEN 'entry' ELSE 'exit' END AS change_type FROM epochs WHERE change_type <> 'Endring')
      UNION ALL SELECT 'change' FROM (
        SELECT change_type, v AS value_to, CASE WHEN row_number() OVER w = 1 THEN CASE WHEN epoch = 0 THEN origin END ELSE lag(v) OVER w END AS value_from FROM (
          SELECT e.*, 'name' AS field, v_name AS v, b.name AS origin FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting' UNION ALL
          SELECT e.*, 'employees', v_k, CAST(b.employees AS VARCHAR) FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting')
        WINDOW w AS (PARTITION BY org_nr, field, epoch ORDER BY "timestamp", update_id)) WHERE change_type = 'Endring' AND value_from IS DISTINCT FROM value_to) GROUP BY change_type""",
    A.CDC.replace("ts AS \"timestamp\"", "date_trunc('second', ts) AS \"timestamp\""), ALL_LIVED,
)
def mirror_changelog(spark, sf):
    """The changelog the two runs left"""
    return mirrored(spark, sf).changelog().groupBy("change_type").agg(F.count("*").alias("n"))


@register(_CHANGES, _WHOLE_SECONDS, ALL_LIVED)
def mirror_changes(spark, sf):
    """The changelog's rows, each batch's committed with its state"""
    return mirrored(spark, sf).changelog().select("timestamp", "org_nr", "change_type", "field", "value_from", "value_to", "update_id")


_AFFECTED = "CAST(org_nr AS INTEGER) % 2 = 0"


@register(f"SELECT org_nr, role_code, person_id, entity_org_nr, ordering FROM roles0 WHERE NOT ({_AFFECTED}) UNION ALL SELECT org_nr, role_code, person_id, entity_org_nr, ordering FROM roles20 WHERE {_AFFECTED}",
          A.ROLES.format(0).replace("roles AS", "roles0 AS", 1), A.ROLES.format(20).replace("roles AS", "roles20 AS", 1))
def mirror_roles(spark, sf):
    """The affected organisations' roles replaced"""
    store, old, new = Store(spark, folder(spark, "roles")), A.roles(spark, sf), A.roles(spark, sf, 20)
    sync.bootstrap(store, "roller", old)
    sync.apply_roles(store, new, "2024-01-01T00:00:00", 1, affected=old.select("org_nr").distinct().where(_AFFECTED))
    return store.state("roller").select("org_nr", "role_code", "person_id", "entity_org_nr", "ordering")


@register(
    f"""SELECT CASE WHEN CAST(org_nr AS BIGINT) % 2 = 0 THEN 'enheter' ELSE 'underenheter' END AS kind, org_nr, name, CAST(employees AS BIGINT) AS n FROM ({_STATE})
    UNION ALL SELECT 'roller', org_nr, NULL, count(*) FROM (SELECT org_nr FROM roles0 WHERE NOT ({_AFFECTED}) UNION ALL SELECT org_nr FROM roles20 WHERE {_AFFECTED}) GROUP BY org_nr
    UNION ALL SELECT 'paategninger', org_nr, NULL, count(*) FROM annotations WHERE org_nr NOT IN (SELECT org_nr FROM cdc WHERE change_type = 'Sletting') GROUP BY org_nr""",
    _WHOLE_SECONDS, ALL_LIVED, A.ANNOTATIONS, A.ROLES.format(0).replace("roles AS", "roles0 AS", 1), A.ROLES.format(20).replace("roles AS", "roles20 AS", 1),
)
def mirror_feeds(spark, sf):
    """Entities, sub-units, roles and annotations from three feeds, bootstrapped and committed together"""
    store, pages = Store(spark, folder(spark, "feeds")), {k: folder(spark, k) for k in ("enheter", "underenheter", "roller")}
    raw, base, even = _entity_events(spark, sf).drop("ts"), A.base(spark, sf), "CAST(organisasjonsnummer AS bigint) % 2 = 0"
    raw.where(even).write.option("compression", "gzip").json(pages["enheter"])
    raw.where(f"NOT {even}").write.option("compression", "gzip").json(pages["underenheter"])
    A.table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").alias("id"), F.lit("no.example.rolle.oppdatert").alias("type"), F.lit("2024-01-01T00:00:00.000Z").alias("time"),
        F.struct(F.col("s_suppkey").cast("string").alias("organisasjonsnummer")).alias("data"),
    ).write.json(pages["roller"])
    mine = lambda x: base.where(f"CAST(org_nr AS bigint) % 2 = {x}")
    initial = {"enheter": mine(0), "underenheter": mine(1), "roller": A.roles(spark, sf), "paategninger": A.annotations(spark, sf)}
    # events apply in time order within a batch, so all files are one
    sync.sync_feeds(store, pages, f"{store.root}/checkpoint", initial, roles=lambda affected: A.roles(spark, sf, 20), files_per_batch=1_000_000)
    view, none = store.tables.view(), F.lit(None).cast("string")
    out = None
    for kind in initial:
        rows = store.state(kind, view)
        if kind in ("enheter", "underenheter"):
            rows = rows.select("org_nr", "name", F.col("employees").cast("long").alias("n"))
        else:
            rows = rows.groupBy("org_nr").agg(F.count("*").alias("n")).select("org_nr", none.alias("name"), "n")
        rows = rows.select(F.lit(kind).alias("kind"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@register(
    """SELECT org_nr, position, infotype, tekst FROM annotations WHERE CAST(org_nr AS BIGINT) % 3 <> 0 UNION ALL
    SELECT org_nr, CAST(max(position) + 1 AS INTEGER), 'FADR', concat('added to ', org_nr) FROM annotations WHERE CAST(org_nr AS BIGINT) % 3 = 1 GROUP BY org_nr""", A.ANNOTATIONS
)
def annotation_patches(spark, sf):
    """Some are cleared, others get one more"""
    return _annotations_patched(spark, sf)[0].select("org_nr", "position", "infotype", "tekst")


@register(
    """SELECT org_nr, 'annotation_cleared' AS change_type, 'paategninger' AS field, CAST(count(*) AS VARCHAR) AS value_from, NULL AS value_to, CAST(org_nr AS BIGINT) + 1 AS update_id FROM annotations WHERE CAST(org_nr AS BIGINT) % 3 = 0 GROUP BY org_nr
    UNION ALL SELECT DISTINCT org_nr, 'annotation_added', 'FADR', NULL, concat('added to ', org_nr), CAST(org_nr AS BIGINT) + 1 FROM annotations WHERE CAST(org_nr AS BIGINT) % 3 = 1""", A.ANNOTATIONS
)
def annotation_changes(spark, sf):
    """The changelog of these patches"""
    return _annotations_patched(spark, sf)[1].select("org_nr", "change_type", "field", "value_from", "value_to", "update_id")


def _annotations_patched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    state = A.annotations(spark, sf)
    who, none = state.select("org_nr").distinct(), F.lit(None).cast("string")
    key = F.col("org_nr").cast("long")
    meta = [(key + 1).alias("update_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp")]
    clear = who.where(key % 3 == 0).select("org_nr", *meta, F.lit("replace").alias("operation"), F.lit("paategninger").alias("field"), none.alias("new_value"))
    parts = F.array(
        F.struct(F.lit("paategninger_-_infotype").alias("field"), F.lit("FADR").alias("new_value")), F.struct(F.lit("paategninger_-_tekst").alias("field"), F.concat(F.lit("added to "), "org_nr").alias("new_value"))
    )
    add = who.where(key % 3 == 1).select("org_nr", *meta, F.lit("add").alias("operation"), F.explode(parts).alias("p")).select("org_nr", "update_id", "timestamp", "operation", "p.field", "p.new_value")
    return changes.apply_annotation_patches(state, clear.unionByName(add))


@register("SELECT org_nr, role_code, person_id, CAST(NULL AS VARCHAR) AS elected_by, CAST(NULL AS DATE) AS group_modified FROM (SELECT * FROM roles) WHERE resigned", A.ROLES.format(0))
def older_roles(spark, sf):
    """A state that lacks columns gets them, NULL"""
    out = diff.backfill_roles(A.roles(spark, sf).where("resigned").drop("elected_by", "group_modified"))
    return out.select("org_nr", "role_code", "person_id", "elected_by", "group_modified")
