"""Registered queries of lookups, sets, drift, time series, flows and networks that need no files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries, exprs, schema
from ..operators import changes, diff, drift, governance, graph, label, lookup, panel, replay
from . import adapters as A
from .files import folder
from .registry import ORACLE_SQL, register

# lookups

#: Numbers of the made-up entities that have a right check digit, from the smallest key on.
VALID = [n for n in (f"9{k:08d}" for k in range(1, 400)) if exprs.is_org_nr(n)][:6]
_IN = ", ".join(f"'{n}'" for n in VALID)


@register(f"SELECT org_nr, name, registry FROM entities WHERE org_nr IN ({_IN})", A.ENTITIES)
def entity_lookups(spark, sf):
    """By number, from either register"""
    e = A.entities(spark, sf)
    main, sub = e.where("registry = 'enheter'").drop("registry"), e.where("registry = 'underenheter'").drop("registry")
    out = None
    for number in VALID:
        found = lookup.entity(number, main, sub).select("org_nr", "name", "registry")
        out = found if out is None else out.unionByName(found)
    return out


_LISTS = (
    ("legal_form", dictionaries.LEGAL_FORMS), ("role_code", {k: v[0] for k, v in dictionaries.ROLE_TYPES.items()}),
    ("role_group_code", {k: v[0] for k, v in dictionaries.ROLE_GROUPS.items()}), ("infotype", dictionaries.INFOTYPES),
)
_text = lambda s: "'" + s.replace("'", "''") + "'"
_VALUES = {name: "(VALUES " + ", ".join(f"({_text(k)}, {_text(v)})" for k, v in codes.items()) + ") AS t(code, label)" for name, codes in _LISTS}


@register(" UNION ALL ".join(f"SELECT '{name}' AS list, code, label FROM {values}" for name, values in _VALUES.items()))
def code_lists(spark, sf):
    """S15"""
    out = None
    for name, _ in _LISTS:
        rows = dictionaries.dictionary(spark, name).select(F.lit(name).alias("list"), "code", "label")
        out = rows if out is None else out.unionByName(rows)
    return out


@register(
    f"""SELECT org_nr, coalesce(n.label, nace_1) AS nace_1, coalesce(s.label, sector_code) AS sector_code FROM (
      SELECT CAST(c_custkey AS VARCHAR) AS org_nr, CAST(c_nationkey AS VARCHAR) AS nace_1, substr(c_mktsegment, 1, 1) AS sector_code FROM customer) c
    LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation) n ON n.code = nace_1 LEFT JOIN (VALUES ('A', 'First'), ('B', 'Second')) AS s(code, label) ON s.code = sector_code"""
)
def label_lists(spark, sf):
    """Lists that the user brings, by the columns they label"""
    nace = A.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    sector = spark.createDataFrame([("A", "First"), ("B", "Second")], "code string, label string")
    tables = dictionaries.label_tables(spark, {"nace_en": nace, "sector_en": sector})
    rows = A.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("org_nr"), F.col("c_nationkey").cast("string").alias("nace_1"), F.substring("c_mktsegment", 1, 1).alias("sector_code"))
    return label.label(rows, tables)


# sets and tests

_SETS = "a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')"


def _holders(spark, sf, status):
    return A.table(spark, sf, "orders").where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"))


@register("SELECT k FROM a EXCEPT SELECT k FROM b", _SETS)
def keys_gone(spark, sf):
    """U2"""
    return _holders(spark, sf, "F").subtract(_holders(spark, sf, "P"))


@register("SELECT k FROM a INTERSECT SELECT k FROM b", _SETS)
def keys_stayed(spark, sf):
    """U3"""
    return _holders(spark, sf, "F").intersect(_holders(spark, sf, "P"))


@register("SELECT org_nr, bankruptcy_date IS NOT DISTINCT FROM liquidation_date AS same, parent_org_nr IS NULL OR coalesce(bankrupt, false) AS flagged FROM entities", A.ENTITIES)
def null_safe_tests(spark, sf):
    """F5, F9"""
    flag = F.when(F.col("parent_org_nr").isNull(), " TRUE").when(F.col("bankrupt"), "1").otherwise("no")
    return A.entities(spark, sf).select("org_nr", exprs.same("bankruptcy_date", "liquidation_date").alias("same"), exprs.flag_set(flag).alias("flagged"))


@register("SELECT change_type, CASE change_type WHEN 'Ny' THEN 'inserted' WHEN 'Sletting' THEN 'deleted' ELSE 'changed' END AS route, count(*) AS n FROM cdc GROUP BY ALL", A.CDC)
def change_routes(spark, sf):
    """F8"""
    kind = F.col("change_type")
    route = F.when(kind.isin(*schema.INSERTED), "inserted").when(kind.isin(*schema.DELETED), "deleted").when(kind.isin(*schema.CHANGED), "changed")
    return A.cdc(spark, sf).groupBy("change_type", route.alias("route")).agg(F.count("*").alias("n"))


@register("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_orders(spark, sf):
    """W3"""
    return diff.first_rows(A.table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


_NOBODY = "held AS (SELECT *, person_id IS NULL AND entity_org_nr IS NULL AS nobody FROM (SELECT org_nr, role_group_code, role_code, ordering, person_id, CASE WHEN ordering % 2 = 0 THEN entity_org_nr END AS entity_org_nr FROM roles))"


@register(
    """SELECT org_nr, split_part(h, ':', 1) AS kind, count(DISTINCT h) AS n FROM (SELECT org_nr, CASE WHEN person_id IS NOT NULL THEN person_id WHEN entity_org_nr IS NOT NULL THEN concat('entity:', entity_org_nr)
      ELSE concat('unknown:', CAST(row_number() OVER (PARTITION BY org_nr, nobody ORDER BY ordering) AS VARCHAR)) END AS h FROM held) WHERE h LIKE 'entity:%' OR h LIKE 'unknown:%' GROUP BY ALL""", A.ROLES.format(0), _NOBODY
)
def unknown_holders(spark, sf):
    """Holders without person or entity are numbered within their organisation"""
    held = A.roles(spark, sf).select("org_nr", "role_group_code", "role_code", "ordering", "person_id", F.when(F.col("ordering") % 2 == 0, F.col("entity_org_nr")).alias("entity_org_nr"))
    keyed = diff.role_key(held).where(F.col("holder_id").rlike("^(entity|unknown):"))
    return keyed.groupBy("org_nr", F.split("holder_id", ":")[0].alias("kind")).agg(F.count_distinct("holder_id").alias("n"))


# time series and flows


@register("SELECT org_nr, snapshot_date, orders FROM snapshots", A.SNAPSHOTS)
def time_series(spark, sf):
    """E5: keyed by organisation, indexed by date, no pair twice"""
    return panel.to_time_series(A.snapshots(spark, sf).select("org_nr", F.col("snapshot_date").cast("string").alias("snapshot_date"), "orders"))[0]


@register("SELECT period, org_nr, CAST(concat(CAST(year(o) AS VARCHAR), '-', lpad(CAST((quarter(o) - 1) * 3 + 1 AS VARCHAR), 2, '0'), '-01') AS DATE) AS day FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS org_nr, concat(CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR), '-Q', CAST(quarter(CAST(o_orderdate AS DATE)) AS VARCHAR)) AS period, date_trunc('quarter', CAST(o_orderdate AS DATE)) AS o FROM orders)")
def quarter_series(spark, sf):
    """Quarters read as the first of their days"""
    period = exprs.format_period(F.col("o_orderdate").cast("date"), "quarter")
    rows = A.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("org_nr"), period.alias("period")).distinct()
    return panel.to_time_series(rows.withColumn("day", F.col("period")), index="day", frequency="quarter")[0]


@register(
    """SELECT registration_date AS date, legal_form, count(*) AS entries, CAST(0 AS BIGINT) AS exits, count(*) AS net FROM entities
    WHERE legal_form IN ('BUILDING', 'MACHINERY') AND registration_date BETWEEN DATE '1995-03-01' AND DATE '1995-09-30' GROUP BY ALL""", A.ENTITIES
)
def flows_by_form(spark, sf):
    """F7, T2, A3"""
    return governance.flows(A.entities(spark, sf), by=("legal_form",), start="1995-03-01", end="1995-09-30", legal_form=("BUILDING", "MACHINERY"))


@register(
    """SELECT CAST(substr("timestamp", 1, 10) AS DATE) AS date, legal_form, count(*) FILTER (change_type = 'entry') AS entries, count(*) FILTER (change_type = 'exit') AS exits,
      count(*) FILTER (change_type = 'entry') - count(*) FILTER (change_type = 'exit') AS net
    FROM (SELECT concat('9', lpad(org_nr, 8, '0')) AS org_nr, "timestamp", change_type FROM changelog WHERE change_type IN ('entry', 'exit')) c LEFT JOIN entities USING (org_nr) GROUP BY ALL""", A.CHANGELOG, A.ENTITIES
)
def flows_changelog_by(spark, sf):
    """Changelog rows take their group from the state"""
    log = A.changelog(spark, sf).withColumn("org_nr", F.concat(F.lit("9"), F.lpad("org_nr", 8, "0")))
    return governance.flows_from_changelog(log, A.entities(spark, sf), ("legal_form",))


# drift

_STATE = "s AS (SELECT *, concat(legal_form, '|', CASE WHEN bankrupt THEN 'konkurs' WHEN liquidation_date IS NOT NULL THEN 'avvikling' ELSE 'ordinary' END) AS segment FROM entities)"


def _segmented(spark, sf):
    e = A.entities(spark, sf).withColumns({"in_liquidation": F.col("liquidation_date").isNotNull(), "forced_dissolution": F.lit(None).cast("boolean")})
    return e.withColumn("segment", drift.segment())


@register("SELECT segment, count(*) AS n FROM s GROUP BY segment", A.ENTITIES, _STATE)
def lifecycle_segments(spark, sf):
    """P17"""
    return _segmented(spark, sf).groupBy("segment").agg(F.count("*").alias("n"))


def _counts(*columns: str) -> str:
    return " UNION ALL ".join(f"SELECT segment, '{c}' AS path, count({c}) AS k, count(*) AS n FROM s GROUP BY segment" for c in columns)


_BEFORE = f"b AS (SELECT * FROM ({_counts('parent_org_nr', 'bankruptcy_date')}) WHERE k > 0), w AS (SELECT * FROM ({_counts('parent_org_nr', 'liquidation_date')}) WHERE k > 0)"


def _periods(spark, sf):
    s = _segmented(spark, sf)
    count = lambda *c: drift.prevalence(s.select("segment", *c), "segment")
    return count("parent_org_nr", "bankruptcy_date"), count("parent_org_nr", "liquidation_date")


@register(
    """SELECT 'new' AS status, segment, path FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY k DESC, segment) AS r FROM w WHERE path NOT IN (SELECT path FROM b)) WHERE r = 1
    UNION ALL SELECT 'removed', segment, path FROM b WHERE (k + 0.5) / (n + 1) >= 0.8 AND segment IN (SELECT segment FROM w) AND (segment, path) NOT IN (SELECT (segment, path) FROM w)""", A.ENTITIES, _STATE, _BEFORE
)
def fields_drifted(spark, sf):
    """D6"""
    return drift.drifted(*_periods(spark, sf))


@register(
    """SELECT segment, path, coalesce(b.k, 0) + coalesce(w.k, 0) AS k_cum, CASE WHEN b.k IS NULL THEN 0 ELSE 1 END + CASE WHEN w.k IS NULL THEN 0 ELSE 1 END AS periods_seen,
    CASE WHEN w.k IS NULL THEN '2024-01' ELSE '2024-02' END AS last_period FROM b FULL JOIN w USING (segment, path)""", A.ENTITIES, _STATE, _BEFORE
)
def fields_cumulated(spark, sf):
    """Two periods"""
    before, now = _periods(spark, sf)
    first = before.select("segment", "path", "type", F.col("k").alias("k_cum"), F.lit(1).alias("periods_seen"), F.lit("2024-01").alias("last_period"))
    return drift.cumulate(first, now, "2024-02").drop("type")


@register(
    """SELECT path, segment, round(theta, 9) AS theta, round(m, 9) AS theta_marg, round(theta - m, 9) AS concentration FROM (
      SELECT *, (k + 0.5) / (n + 1) AS theta, row_number() OVER (PARTITION BY path ORDER BY (k + 0.5) / (n + 1) DESC, segment) AS r FROM b)
    JOIN (SELECT path, sum(k) / (SELECT sum(n) FROM (SELECT DISTINCT segment, n FROM b)) AS m FROM b GROUP BY path) USING (path) WHERE r = 1""", A.ENTITIES, _STATE, _BEFORE
)
def field_drivers(spark, sf):
    """Conditional against marginal shares"""
    out = drift.concentration(_periods(spark, sf)[0])
    return out.select("path", "segment", *[F.round(c, 9).alias(c) for c in ("theta", "theta_marg", "concentration")])


@register("SELECT segment, max(n) AS n, count(*) AS n_fields FROM b GROUP BY segment", A.ENTITIES, _STATE, _BEFORE)
def segment_coverage(spark, sf):
    """What each segment is seen to fill"""
    return drift.coverage(_periods(spark, sf)[0])


_FEEDS = """f1 AS (SELECT 'doc' AS kind, CAST(p_partkey AS VARCHAR) AS item, md5(p_brand) AS hash FROM part WHERE p_partkey % 5 <> 0),
 f2 AS (SELECT 'doc' AS kind, CAST(p_partkey AS VARCHAR) AS item, md5(CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE p_brand END) AS hash FROM part)"""


@register("SELECT kind, item, 'new' AS status FROM f2 WHERE item NOT IN (SELECT item FROM f1) UNION ALL SELECT kind, item, 'changed' FROM f2 JOIN f1 USING (kind, item) WHERE f1.hash <> f2.hash", _FEEDS)
def sources_changed(spark, sf):
    """D7, J18"""
    part, key = A.table(spark, sf, "part"), F.col("p_partkey")
    row = lambda hashed: (F.lit("doc").alias("kind"), key.cast("string").alias("item"), F.md5(hashed.cast("binary")).alias("hash"))
    return drift.source_changes(part.where(key % 5 != 0).select(*row(F.col("p_brand"))), part.select(*row(F.when(key % 7 == 0, F.col("p_name")).otherwise(F.col("p_brand")))))


@register("SELECT segment, path, k FROM b ORDER BY k DESC, segment, path LIMIT 12", A.ENTITIES, _STATE, _BEFORE)
def report_top(spark, sf):
    """A report's first rows"""
    return drift.report_rows(_periods(spark, sf)[0], ("segment", "path", "k"), 12)


@register("SELECT segment, path, k, n FROM b", A.ENTITIES, _STATE, _BEFORE)
def counts_tsv(spark, sf):
    """Written as tab-separated values, and read again"""
    path = folder(spark, "counts")
    drift.write_tsv(_periods(spark, sf)[0].drop("type"), path)
    return spark.read.option("sep", "\t").option("header", True).schema("segment string, path string, k long, n long").csv(path)


# networks

_SEEDS = ("900000003", "900000005", "900000012")
_SEED_SQL = "seeds AS (SELECT unnest([" + ", ".join(f"'{s}'" for s in _SEEDS) + "]) AS org_nr)"
#: Roles of the made-up entities: suppliers and customers share one numbering.
_HELD = """held AS (SELECT DISTINCT concat('9', lpad(org_nr, 8, '0')) AS org_nr, role_code, role, first_name, last_name, person_id, CASE WHEN entity_org_nr IS NOT NULL THEN concat('9', lpad(entity_org_nr, 8, '0')) END AS entity_org_nr, entity_name, resigned, deregistered FROM roles),
 legal AS (SELECT DISTINCT entity_org_nr AS org_nr, h.org_nr AS target_org_nr, e.name AS target_name, role_code, role FROM held h LEFT JOIN entities e ON e.org_nr = h.org_nr WHERE entity_org_nr IS NOT NULL)"""
_NODES = """n1 AS (
  SELECT concat('o:', s.org_nr) AS node_id, coalesce(e.registry, 'entity') AS node_type, e.name, s.org_nr, CAST(NULL AS VARCHAR) AS person_id, 0 AS rank FROM seeds s LEFT JOIN entities e ON e.org_nr = s.org_nr
  UNION ALL SELECT concat('o:', org_nr), 'underenhet', name, org_nr, NULL, 1 FROM entities WHERE registry = 'underenheter' AND parent_org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('o:', org_nr), 'child_entity', name, org_nr, NULL, 2 FROM entities WHERE registry = 'enheter' AND parent_org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('p:', person_id), 'person', concat_ws(' ', first_name, last_name), NULL, person_id, 3 FROM held WHERE person_id IS NOT NULL AND org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('o:', entity_org_nr), 'role_holder_entity', entity_name, entity_org_nr, NULL, 4 FROM held WHERE person_id IS NULL AND entity_org_nr IS NOT NULL AND org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('o:', target_org_nr), 'legal_role_target', target_name, target_org_nr, NULL, 5 FROM legal WHERE org_nr IN (SELECT org_nr FROM seeds)),
 further AS (SELECT * FROM held WHERE person_id IN (SELECT person_id FROM held WHERE org_nr IN (SELECT org_nr FROM seeds) AND person_id IS NOT NULL) AND org_nr NOT IN (SELECT org_nr FROM n1 WHERE org_nr IS NOT NULL)),
 n2 AS (SELECT * FROM n1 UNION ALL SELECT DISTINCT concat('o:', f.org_nr), 'entity', e.name, f.org_nr, NULL, 6 FROM further f LEFT JOIN entities e ON e.org_nr = f.org_nr)"""
_MERGED = "SELECT node_id, node_type, name, org_nr, person_id FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY rank, node_type, name NULLS LAST) AS r FROM {0}) WHERE r = 1"
_EDGES = """SELECT concat('o:', parent_org_nr) AS "from", concat('o:', org_nr) AS "to", CASE registry WHEN 'underenheter' THEN 'has_establishment' ELSE 'parent_of' END AS edge_type, CAST(NULL AS VARCHAR) AS role_code
  FROM entities WHERE parent_org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('p:', person_id), concat('o:', org_nr), 'role', role_code FROM held WHERE person_id IS NOT NULL AND org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('o:', entity_org_nr), concat('o:', org_nr), 'entity_role', role_code FROM held WHERE person_id IS NULL AND entity_org_nr IS NOT NULL AND org_nr IN (SELECT org_nr FROM seeds)
  UNION ALL SELECT concat('o:', org_nr), concat('o:', target_org_nr), 'legal_role', role_code FROM legal WHERE org_nr IN (SELECT org_nr FROM seeds)"""


def _network(spark, sf, depth):
    e = A.entities(spark, sf).select("org_nr", "name", "parent_org_nr", "registry")
    nine = lambda c: F.when(c.isNotNull(), F.concat(F.lit("9"), F.lpad(c, 8, "0")))
    # told apart by what these columns come from, which is narrower than they are
    told = ("org_nr", "role_code", "role", "first_name", "last_name", "person_id", "entity_org_nr", "entity_name", "resigned", "deregistered")
    held = A.roles(spark, sf, columns=told, org=nine).withColumn("entity_org_nr", nine(F.col("entity_org_nr")))
    legal = lookup.legal_roles(held, e).select("org_nr", "target_org_nr", "target_name", "role_code", "role").distinct()
    tables = {"sub_units": e.where("registry = 'underenheter'"), "children": e.where("registry = 'enheter'"), "roles": held, "legal_roles": legal}
    # few by what Spark knows of them, so they are sent to the lines instead of the lines to them
    seeds = spark.sql(f"SELECT explode(array({', '.join(repr(s) for s in _SEEDS)})) AS org_nr")
    return graph.network(seeds, e, tables, depth)


_GRAPH = (A.ENTITIES, A.ROLES.format(0), _SEED_SQL, _HELD, _NODES)


@register(_MERGED.format("n1"), *_GRAPH)
def network_nodes(spark, sf):
    """Sub-units, children, roles and legal roles"""
    return _network(spark, sf, 1)[0]


@register(_EDGES, *_GRAPH)
def network_edges(spark, sf):
    """G3, G5, J13"""
    return _network(spark, sf, 1)[1].drop("role")


@register(_MERGED.format("n2"), *_GRAPH)
def network_depth_2(spark, sf):
    """Interlocks as well"""
    return _network(spark, sf, 2)[0]


@register("SELECT \"timestamp\", org_nr, change_type, field, update_id FROM changelog WHERE change_type IN ('entry', 'exit') AND registry = 'roller'", A.CHANGELOG)
def changes_by_kind(spark, sf):
    """by kind of change"""
    out = changes.changes(A.changelog(spark, sf), registry="roller", change_type=("entry", "exit"))
    return out.select("timestamp", "org_nr", "change_type", "field", "update_id")


# many dates, chains of mergers, empty tables

_PANEL_DATES = tuple(f"2024-01-{d:02d}" for d in range(3, 27, 2))
_WHOLE = ORACLE_SQL["replay_asof"]


@register(" UNION ALL ".join(f"SELECT *, DATE '{d}' AS target_date FROM ({_WHOLE.replace('2024-01-21', d)})" for d in _PANEL_DATES))
def replay_panel(spark, sf):
    """Twelve dates in one pass over the feed"""
    return replay.replay_dates(A.base(spark, sf), A.cdc(spark, sf), _PANEL_DATES)


@register(
    """SELECT e.org_nr, e.municipality_code, coalesce(w.target_code, e.municipality_code) AS municipality_code_harmonized, w.target_name AS municipality_code_target_name FROM entities e
    LEFT JOIN (SELECT source_code, arg_max(target_code, steps) AS target_code, arg_max(target_name, steps) AS target_name FROM walk GROUP BY source_code) w ON w.source_code = e.municipality_code""",
    "RECURSIVE " + A.ENTITIES,
    """merges AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS source_code, lpad(CAST(n_nationkey + 1 AS VARCHAR), 4, '0') AS target_code, concat('after ', n_name) AS target_name,
      CAST(DATE '2000-01-01' + n_nationkey * 30 AS DATE) AS valid_from FROM nation WHERE n_nationkey % 5 <> 4)""",
    """walk AS (SELECT source_code, target_code, target_name, valid_from, 1 AS steps FROM merges WHERE valid_from <= DATE '2001-06-01'
      UNION ALL SELECT w.source_code, m.target_code, m.target_name, m.valid_from, w.steps + 1 FROM walk w JOIN merges m ON m.source_code = w.target_code AND m.valid_from >= w.valid_from AND m.valid_from <= DATE '2001-06-01')""",
)
def harmonize_chains(spark, sf):
    """L4: municipalities merged several times reach their present code"""
    n, code = F.col("n_nationkey"), lambda c: F.lpad(c.cast("string"), 4, "0")
    merges = A.table(spark, sf, "nation").where(n % 5 != 4).select(
        code(n).alias("source_code"), code(n + 1).alias("target_code"), F.concat(F.lit("after "), "n_name").alias("target_name"), F.date_add(F.lit("2000-01-01").cast("date"), (n * 30).cast("int")).alias("valid_from")
    )
    held = A.entities(spark, sf).select("org_nr", "municipality_code")
    return label.harmonize_merged(held, merges, "2001-06-01").drop("municipality_code_cyclic")


@register("SELECT * FROM (SELECT \"timestamp\", org_nr, registry, change_type, field, value_to, update_id FROM changelog) UNION ALL SELECT \"timestamp\", org_nr, registry, change_type, field, value_to, update_id FROM changelog WHERE false", A.CHANGELOG)
def empty_changelog(spark, sf):
    """A typed table without rows joins any other by name"""
    rows = A.changelog(spark, sf).drop("sync_date")
    return schema.empty(spark, schema.CHANGELOG).unionByName(rows, allowMissingColumns=True).drop("value_from")
