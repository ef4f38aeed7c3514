"""The registered queries of the registry operators; names lead to SURVEY's inventory by their docstrings and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries, exprs
from ..operators import changes, diff, drift, governance, graph, label, lookup, panel, replay
from ..sources import ingest, store, updates
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str | None = None, *ctes: str):
    """Register a query under its function's name, with SQL over the named CTEs where SQL can tell its rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


# identifiers, names, lookups


@register(
    """SELECT nr, nr SIMILAR TO '[89][0-9]{8}' AND chk <> 10 AND chk = CAST(substr(nr, 9, 1) AS INTEGER) AS valid FROM (SELECT nr, (11 - s % 11) % 11 AS chk FROM (
      SELECT nr, """ + " + ".join(f"CAST(substr(nr, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(exprs.WEIGHTS)) + """ AS s
      FROM (SELECT concat(CAST(7 + c_custkey % 3 AS VARCHAR), lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0')) AS nr FROM customer)))"""
)
def org_validate(spark, sf):
    """F1"""
    nr = F.concat((7 + F.col("c_custkey") % 3).cast("string"), F.lpad((F.col("c_custkey") * 7919 % 100000000).cast("string"), 8, "0"))
    return A.table(spark, sf, "customer").select(nr.alias("nr")).select("nr", exprs.valid_org_nr("nr").alias("valid"))


@register("SELECT org_nr, name, legal_form, employees FROM entities WHERE contains(lower(name), '7') AND legal_form IN ('BUILDING', 'MACHINERY') AND employees BETWEEN 50 AND 400 ORDER BY org_nr LIMIT 50", A.ENTITIES)
def search_filter(spark, sf):
    """S2, T4"""
    return lookup.search(A.entities(spark, sf), name="7", legal_form=("BUILDING", "MACHINERY"), min_employees=50, max_employees=400, max_results=50)[0].select("org_nr", "name", "legal_form", "employees")


@register("SELECT CAST(count(*) AS BIGINT) AS total_matches FROM entities WHERE bankrupt AND municipality_code IN ('0003', '0007')", A.ENTITIES)
def search_total(spark, sf):
    """S2"""
    return lookup.search(A.entities(spark, sf), municipality_code=("0003", "0007"), bankrupt=True)[1]


@register("SELECT org_nr, name FROM entities WHERE parent_org_nr = '900000003'", A.ENTITIES)
def children_of(spark, sf):
    """S3, S4"""
    return lookup.owned_by(A.entities(spark, sf), "900000003").select("org_nr", "name")


@register("SELECT org_nr, role_code, person_id, ordering FROM roles WHERE org_nr = '7'", A.ROLES.format(0))
def roles_of(spark, sf):
    """S5"""
    return lookup.roles_of(A.roles(spark, sf), "7").select("org_nr", "role_code", "person_id", "ordering")


@register(
    """SELECT r.entity_org_nr AS org_nr, r.org_nr AS target_org_nr, s_name AS target_name, r.role_code, r.resigned, false AS deregistered
    FROM roles r LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = r.org_nr WHERE entity_org_nr IS NOT NULL""", A.ROLES.format(0)
)
def legal_roles(spark, sf):
    """S6"""
    names = A.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("org_nr"), F.col("s_name").alias("name"))
    return lookup.legal_roles(A.roles(spark, sf), names).drop("role", "share")


@register("SELECT org_nr, legal_form FROM entities WHERE legal_form IN (SELECT DISTINCT legal_form FROM entities WHERE employees = 7)", A.ENTITIES)
def filter_values(spark, sf):
    """F2"""
    e = A.entities(spark, sf)
    return lookup.filter_table(e, "legal_form", e.where("employees = 7").select("legal_form"), ("org_nr", "legal_form"))


# labels and concordances

_NATION = "codes AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS code, n_name AS label FROM nation WHERE n_nationkey < 20)"


def _nations(spark, sf):
    return A.table(spark, sf, "nation").where("n_nationkey < 20").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("code"), F.col("n_name").alias("label"))


@register("SELECT org_nr, coalesce(label, municipality_code) AS municipality_code FROM entities LEFT JOIN codes ON code = municipality_code", A.ENTITIES, _NATION)
def label_codes(spark, sf):
    """L1, J10"""
    return label.label(A.entities(spark, sf).select("org_nr", "municipality_code"), {"municipality_code": _nations(spark, sf)})


@register("SELECT org_nr, municipality_code AS municipality_code_code, coalesce(label, municipality_code) AS municipality_code FROM entities LEFT JOIN codes ON code = municipality_code", A.ENTITIES, _NATION)
def label_keep_code(spark, sf):
    """L1"""
    return label.label(A.entities(spark, sf).select("org_nr", "municipality_code"), {"municipality_code": _nations(spark, sf)}, ("municipality_code",))


@register(
    """SELECT org_nr, municipality_code, coalesce(t.code, municipality_code) AS municipality_code_harmonized, t.name AS municipality_code_target_name FROM entities LEFT JOIN (
      SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS source, concat('r', CAST(n_regionkey AS VARCHAR)) AS code, r_name AS name FROM nation JOIN region ON r_regionkey = n_regionkey
      WHERE n_nationkey % 2 = 0) t ON t.source = municipality_code""", A.ENTITIES
)
def harmonize_remap(spark, sf):
    """L4"""
    table = A.table(spark, sf, "nation").join(A.table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("source_code"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("target_code"), F.col("r_name").alias("target_name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("2000-01-01")).otherwise("2030-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    return label.harmonize_municipality(A.entities(spark, sf).select("org_nr", "municipality_code"), table, "2024-01-01")


@register(
    """SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS nace_1, t.code AS nace_1_harmonized, t.n > 1 AS nace_1_ambiguous FROM nation JOIN (
      SELECT n_regionkey AS k, min(n_name) AS code, count(DISTINCT n_name) AS n FROM nation GROUP BY 1) t ON k = n_regionkey"""
)
def harmonize_ambiguous(spark, sf):
    """L5, J11, A9"""
    n = A.table(spark, sf, "nation")
    return label.harmonize_nace(n.select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("nace_1")), n.select(F.col("n_regionkey").cast("string").alias("source_code"), F.col("n_name").alias("target_code")))


# periods, panels, series

for _frequency, _months in (("year", 12), ("quarter", 3), ("month", 1)):

    def _targets(spark, sf, frequency=_frequency):
        """E2"""
        return panel.period_targets(spark, "1996-03-15", "1999-05-02", frequency)

    _targets.__name__ = f"period_targets_{_frequency}"
    register(
        f"SELECT last_day(CAST(d + INTERVAL {_months - 1} MONTH AS DATE)) AS target_date FROM (SELECT unnest(generate_series(date_trunc('{_frequency}', DATE '1996-03-15'), date_trunc('{_frequency}', DATE '1999-05-02'), INTERVAL {_months} MONTH)) AS d)"
    )(_targets)

_TARGETS = "targets AS (SELECT last_day(CAST(d + INTERVAL 2 MONTH AS DATE)) AS target_date FROM (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-07-01', INTERVAL 3 MONTH)) AS d))"
_AVAILABLE = f"available AS (SELECT unnest([{', '.join(f"DATE '{d}'" for d in A.SNAPSHOT_DATES)}]) AS snapshot_date)"
_MAPPING = "mapping AS (SELECT target_date, max(snapshot_date) AS snapshot_date, CAST(target_date AS VARCHAR) AS period FROM targets JOIN available ON snapshot_date <= target_date GROUP BY target_date)"


def _mapping(spark, gap=None):
    return panel.locf(panel.period_targets(spark, "1996-01-01", "2000-09-30", "quarter"), A.available(spark), gap)


@register("SELECT * FROM mapping", _TARGETS, _AVAILABLE, _MAPPING)
def locf_mapping(spark, sf):
    """J2, E3"""
    return _mapping(spark)


@register("SELECT * FROM mapping WHERE target_date - snapshot_date <= 184", _TARGETS, _AVAILABLE, _MAPPING)
def locf_mapping_max_gap(spark, sf):
    """J3"""
    return _mapping(spark, panel.gap_days(2, "quarter"))


@register(
    """SELECT org_nr, snapshot_date, status, orders, target_date, period, period = min(period) OVER w AS is_entry, period = max(period) OVER w AS is_exit
    FROM snapshots JOIN mapping USING (snapshot_date) WINDOW w AS (PARTITION BY org_nr)""", A.SNAPSHOTS, _TARGETS, _AVAILABLE, _MAPPING
)
def panel_quarter(spark, sf):
    """E1, J1, W1"""
    return panel.panel(A.snapshots(spark, sf), _mapping(spark), ("status", "orders"))


@register("SELECT period, status, count(*) AS n FROM snapshots JOIN mapping USING (snapshot_date) GROUP BY ALL", A.SNAPSHOTS, _TARGETS, _AVAILABLE, _MAPPING)
def series_count(spark, sf):
    """A1"""
    return panel.series(A.snapshots(spark, sf), _mapping(spark), by=("status",))


@register(
    """SELECT period, CAST(sum(orders) AS BIGINT) AS orders_total, round(avg(orders), 6) AS orders_mean, min(orders) AS orders_min, max(orders) AS orders_max, count(DISTINCT orders) AS orders_n_distinct
    FROM snapshots JOIN mapping USING (snapshot_date) GROUP BY period""", A.SNAPSHOTS, _TARGETS, _AVAILABLE, _MAPPING
)
def series_multi_fn(spark, sf):
    """A1"""
    out = panel.series(A.snapshots(spark, sf), _mapping(spark), ("orders",), ("total", "mean", "min", "max", "n_distinct"))
    return out.withColumn("orders_mean", F.round("orders_mean", 6))


@register("SELECT DISTINCT o_orderdate::DATE AS d, strftime(o_orderdate, '%Y') AS y, concat(strftime(o_orderdate, '%Y'), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS q, strftime(o_orderdate, '%Y-%m') AS m, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS back FROM orders")
def period_formats(spark, sf):
    """E4, E5"""
    d = A.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    out = d.select("d", *[exprs.format_period("d", f).alias(n) for f, n in (("year", "y"), ("quarter", "q"), ("month", "m"))])
    return out.withColumn("back", exprs.parse_period("q"))


# differences

_OLD_NEW = "o AS (SELECT * FROM snapshots WHERE snapshot_date = DATE '1997-12-31'), n AS (SELECT * FROM snapshots WHERE snapshot_date = DATE '1998-12-31')"
_FIELDS = " UNION ALL ".join(
    f"SELECT n.org_nr, 'change' AS event_type, DATE '1998-12-31' AS event_date, '{c}' AS field, CAST(o.{c} AS VARCHAR) AS value_from, CAST(n.{c} AS VARCHAR) AS value_to FROM o JOIN n ON o.org_nr = n.org_nr WHERE o.{c} IS DISTINCT FROM n.{c}"
    for c in ("status", "priority", "orders")
)


@register(
    f"""SELECT coalesce(o.org_nr, n.org_nr) AS org_nr, CASE WHEN o.org_nr IS NULL THEN 'entry' ELSE 'exit' END AS event_type, DATE '1998-12-31' AS event_date,
    CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS value_from, CAST(NULL AS VARCHAR) AS value_to FROM o FULL JOIN n ON o.org_nr = n.org_nr WHERE o.org_nr IS NULL OR n.org_nr IS NULL UNION ALL {_FIELDS}""", A.SNAPSHOTS, _OLD_NEW
)
def snapshot_diff(spark, sf):
    """The flagship"""
    s = A.snapshots(spark, sf)
    at = lambda d: s.where(F.col("snapshot_date") == F.lit(d).cast("date")).drop("snapshot_date")
    return diff.snapshot_events(at("1997-12-31"), at("1998-12-31"), "1998-12-31")


_KEYED = """keyed{0} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role_key ORDER BY ordering, deceased, resigned, elected_by NULLS LAST) AS rn FROM (
  SELECT *, concat_ws('|', org_nr, role_group_code, role_code, coalesce(person_id, concat('entity:', entity_org_nr))) AS role_key FROM roles{0})) WHERE rn = 1)"""
_ROLE_FIELDS = " UNION ALL ".join(
    f"SELECT role_key, org_nr, CASE WHEN o.role_key IS NULL THEN 'entry' WHEN n.role_key IS NULL THEN 'exit' ELSE 'change' END AS change_type, '{c}' AS field, {x.format(f'o.{c}')} AS value_from, {x.format(f'n.{c}')} AS value_to "
    f"FROM keyed0 o FULL JOIN keyed20 n USING (role_key, org_nr) WHERE {x.format(f'o.{c}')} IS DISTINCT FROM {x.format(f'n.{c}')}"
    for c, x in (("first_name", "{0}"), ("last_name", "{0}"), ("deceased", "upper(CAST({0} AS VARCHAR))"), ("resigned", "upper(CAST({0} AS VARCHAR))"), ("ordering", "CAST({0} AS VARCHAR)"), ("elected_by", "{0}"), ("entity_org_nr", "{0}"))
)


@register(
    f"SELECT * FROM ({_ROLE_FIELDS})", A.ROLES.format(0).replace("roles AS", "roles0 AS", 1), A.ROLES.format(20).replace("roles AS", "roles20 AS", 1), _KEYED.format(0), _KEYED.format(20)
)
def role_diff(spark, sf):
    """D2-D4, J8, P15"""
    columns = ("first_name", "last_name", "deceased", "resigned", "ordering", "elected_by", "entity_org_nr")
    out = diff.role_changes(A.roles(spark, sf), A.roles(spark, sf, 20), "2024-01-01T00:00:00", 1, columns, ("ordering", "deceased", "resigned", "elected_by"))
    return out.select("role_key", "org_nr", "change_type", "field", "value_from", "value_to")


@register("SELECT e.org_nr, e.name, CASE WHEN u.org_nr IS NOT NULL THEN u.employees ELSE e.employees END AS employees FROM entities e LEFT JOIN (SELECT org_nr, CAST(employees + 1 AS INTEGER) AS employees FROM entities WHERE bankrupt) u ON e.org_nr = u.org_nr", A.ENTITIES)
def rows_update(spark, sf):
    """J9"""
    e = A.entities(spark, sf).select("org_nr", "name", "employees", "bankrupt")
    return diff.rows_update(e.drop("bankrupt"), e.where("bankrupt").select("org_nr", (F.col("employees") + 1).cast("int").alias("employees")), "org_nr", ("employees",))


@register("SELECT org_nr, name, CAST(NULL AS VARCHAR) AS legal_form FROM entities WHERE bankrupt UNION ALL SELECT org_nr, NULL, legal_form FROM entities WHERE NOT bankrupt", A.ENTITIES)
def union_by_name(spark, sf):
    """U1, J17"""
    e = A.entities(spark, sf)
    return e.where("bankrupt").select("org_nr", "name").unionByName(e.where("NOT bankrupt").select("org_nr", "legal_form"), allowMissingColumns=True)


# changelog and annotations


@register("SELECT registry, change_type, field, count(*) AS n FROM changelog GROUP BY ALL", A.CHANGELOG)
def change_summary(spark, sf):
    """A5, T3"""
    return changes.change_summary(A.changelog(spark, sf))


@register("SELECT change_type, count(DISTINCT org_nr) AS n_entities, count(*) AS n FROM changelog GROUP BY ALL", A.CHANGELOG)
def change_totals(spark, sf):
    """A8"""
    return changes.change_totals(A.changelog(spark, sf))


@register("SELECT * FROM changelog WHERE sync_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND registry = 'enheter' AND (field IS NULL OR field IN ('view', 'purchase'))", A.CHANGELOG)
def changes_tracked(spark, sf):
    """F3, S19, T1"""
    return changes.changes(A.changelog(spark, sf), ("view", "purchase"), "enheter", start="2024-01-05", end="2024-01-20")


@register("SELECT infotype, count(DISTINCT org_nr) AS n_entities, count(*) AS n_annotations FROM annotations GROUP BY infotype", A.ANNOTATIONS)
def annotation_summary(spark, sf):
    """A6"""
    return changes.annotation_summary(A.annotations(spark, sf))


@register("SELECT org_nr, position, infotype, CASE infotype WHEN 'FADR' THEN 'Business address presumed incorrect' WHEN 'NAVN' THEN 'Name annotation' ELSE infotype END AS infotype_desc, tekst, innfoert_dato FROM annotations", A.ANNOTATIONS)
def annotations_labelled(spark, sf):
    """F4, L3"""
    return changes.annotations(A.annotations(spark, sf), infotypes=dictionaries.dictionary(spark, "infotype"))


@register("SELECT CAST(conv_id AS VARCHAR) AS org_nr, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS position, role AS infotype, text AS tekst, CAST(turn AS VARCHAR) AS innfoert_dato FROM conversations")
def annotations_explode(spark, sf):
    """S24"""
    item = F.struct("turn", F.col("role").alias("infotype"), F.col("text").alias("tekst"), F.col("turn").cast("string").alias("innfoertDato"))
    rows = A.table(spark, sf, "conversations").groupBy(F.col("conv_id").cast("string").alias("org_nr")).agg(F.array_sort(F.collect_list(item)).alias("annotations"))
    return changes.explode_annotations(rows)


# flows, boards, survival


@register("SELECT registration_date AS date, CAST(count(*) AS BIGINT) AS entries, CAST(0 AS BIGINT) AS exits, CAST(count(*) AS BIGINT) AS net FROM entities WHERE registration_date BETWEEN DATE '1995-02-01' AND DATE '1996-06-30' GROUP BY 1", A.ENTITIES)
def flows_daily(spark, sf):
    """A3"""
    return governance.flows(A.entities(spark, sf), start="1995-02-01", end="1996-06-30")


@register(
    """SELECT date, legal_form, CAST(sum(i) AS BIGINT) AS entries, CAST(sum(o) AS BIGINT) AS exits, CAST(sum(i) - sum(o) AS BIGINT) AS net FROM (
      SELECT registration_date AS date, legal_form, 1 AS i, 0 AS o FROM entities UNION ALL
      SELECT CAST("timestamp" AS DATE), legal_form, CASE WHEN change_type = 'Ny' THEN 1 ELSE 0 END, CASE WHEN change_type = 'Ny' THEN 0 ELSE 1 END
      FROM (SELECT concat('9', lpad(org_nr, 8, '0')) AS org_nr, change_type, "timestamp" FROM cdc WHERE change_type IN ('Ny', 'Sletting')) c LEFT JOIN entities USING (org_nr)) GROUP BY ALL""", A.ENTITIES, A.CDC
)
def flows_with_exits(spark, sf):
    """A3, J4, J6"""
    feed = A.cdc(spark, sf).withColumn("org_nr", F.concat(F.lit("9"), F.lpad("org_nr", 8, "0")))
    return governance.flows(A.entities(spark, sf), feed, ("legal_form",))


@register("SELECT CAST(substr(\"timestamp\", 1, 10) AS DATE) AS date, CAST(count(*) FILTER (change_type = 'entry') AS BIGINT) AS entries, CAST(count(*) FILTER (change_type = 'exit') AS BIGINT) AS exits, CAST(count(*) FILTER (change_type = 'entry') - count(*) FILTER (change_type = 'exit') AS BIGINT) AS net FROM changelog WHERE change_type IN ('entry', 'exit') GROUP BY 1", A.CHANGELOG)
def flows_changelog(spark, sf):
    """A4"""
    return governance.flows_from_changelog(A.changelog(spark, sf))


_BOARD = "active AND role_group_code = 'STYR' AND person_id IS NOT NULL"


@register(
    f"SELECT org_nr, count(*) FILTER ({_BOARD}) AS board_size, " + ", ".join(f"count(*) FILTER ({_BOARD} AND role_code = '{c}') AS {n}" for n, c in governance.BOARD_COUNTS.items()) + f""",
    count(*) FILTER ({_BOARD} AND elected_by IS NOT NULL) AS n_employee_elected, coalesce(bool_or(active AND role_code = 'DAGL'), false) AS has_ceo, coalesce(bool_or(active AND role_code = 'REVI'), false) AS has_auditor,
    arg_min(entity_org_nr, (ordering, entity_org_nr)) FILTER (active AND role_code = 'REVI') AS auditor_org_nr FROM (SELECT *, NOT coalesce(resigned, false) AND NOT coalesce(deregistered, false) AS active FROM roles) GROUP BY org_nr""", A.ROLES.format(0)
)
def board_summary(spark, sf):
    """A2, F6"""
    return governance.board_summary(A.roles(spark, sf))


@register(
    """SELECT org_nr, founding_date AS entry_date, x AS exit_date, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS event,
    CASE WHEN coalesce(x, DATE '2000-01-01') >= founding_date THEN round((coalesce(x, DATE '2000-01-01') - founding_date) / 365.25, 6) END AS duration_years
    FROM (SELECT *, least(bankruptcy_date, liquidation_date) AS x FROM entities)""", A.ENTITIES
)
def survival(spark, sf):
    """E6"""
    out = governance.survival(A.entities(spark, sf), "2000-01-01")
    return out.select("org_nr", "entry_date", "exit_date", "event", F.round("duration_years", 6).alias("duration_years"))


# change feed

_PATCHES = """SELECT update_id, org_nr, change_type, "timestamp", 'navn' AS field, v_name AS new_value, 0 AS pos FROM cdc UNION ALL SELECT update_id, org_nr, change_type, "timestamp", 'antallAnsatte', v_k, 1 FROM cdc"""


@register(f"SELECT update_id, org_nr, change_type, 'replace' AS operation, field, new_value FROM ({_PATCHES})", A.CDC)
def cdc_flatten(spark, sf):
    """P11, S14"""
    return updates.update_fields(A.cdc(spark, sf)).drop("timestamp")


_LIVED = """lived AS (SELECT *, CASE change_type WHEN 'Ny' THEN NOT before ELSE before END AS effective FROM (SELECT c.*, coalesce(
    last_value(CASE change_type WHEN 'Ny' THEN true WHEN 'Sletting' THEN false END IGNORE NULLS) OVER (PARTITION BY c.org_nr ORDER BY "timestamp", update_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), b.org_nr IS NOT NULL) AS before
  FROM cdc c LEFT JOIN base b ON b.org_nr = c.org_nr WHERE "timestamp" <= TIMESTAMP '2024-01-21')),
 epochs AS (SELECT *, sum(CASE WHEN effective AND change_type = 'Sletting' THEN 1 ELSE 0 END) OVER (PARTITION BY org_nr ORDER BY "timestamp", update_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM lived),
 final AS (SELECT org_nr, max(epoch) AS last_epoch, arg_max(change_type <> 'Sletting', ("timestamp", update_id)) FILTER (effective) AS alive FROM epochs GROUP BY org_nr)"""


@register(
    """SELECT org_nr, CASE WHEN p.seen THEN p.name WHEN coalesce(last_epoch, 0) = 0 THEN b.name END AS name, CASE WHEN p.seen THEN p.employees WHEN coalesce(last_epoch, 0) = 0 THEN b.employees END AS employees
    FROM base b FULL JOIN final USING (org_nr) LEFT JOIN (SELECT e.org_nr, true AS seen, arg_max(v_name, ("timestamp", update_id)) AS name, CAST(arg_max(v_k, ("timestamp", update_id)) AS INTEGER) AS employees
      FROM epochs e JOIN final f ON f.org_nr = e.org_nr AND epoch = last_epoch WHERE effective AND change_type <> 'Sletting' GROUP BY e.org_nr) p USING (org_nr)
    WHERE coalesce(alive, b.org_nr IS NOT NULL)""", A.CDC, _LIVED
)
def replay_asof(spark, sf):
    """C1, W5, P18"""
    return replay.replay(A.base(spark, sf), A.cdc(spark, sf), "2024-01-21")


@register("SELECT count(*) FILTER (effective AND change_type = 'Ny') AS n_insert, count(*) FILTER (effective AND change_type = 'Endring') AS n_update, count(*) FILTER (effective AND change_type = 'Sletting') AS n_delete FROM epochs", A.CDC, _LIVED)
def replay_counters(spark, sf):
    """A12"""
    return replay.counters(replay.lived(A.base(spark, sf), replay.until(A.cdc(spark, sf), "2024-01-21")))


@register(
    """SELECT org_nr, change_type, field, value_from, value_to, update_id FROM (
      SELECT org_nr, CASE change_type WHEN 'Ny' THEN 'entry' ELSE 'exit' END AS change_type, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS value_from, CAST(NULL AS VARCHAR) AS value_to, update_id FROM epochs WHERE change_type <> 'Endring'
      UNION ALL SELECT org_nr, 'change', field, value_from, value_to, update_id FROM (
        SELECT org_nr, change_type, field, update_id, v AS value_to, CASE WHEN row_number() OVER w = 1 THEN CASE WHEN epoch = 0 THEN origin END ELSE lag(v) OVER w END AS value_from FROM (
          SELECT e.*, 'name' AS field, v_name AS v, b.name AS origin FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting' UNION ALL
          SELECT e.*, 'employees', v_k, CAST(b.employees AS VARCHAR) FROM epochs e LEFT JOIN base b USING (org_nr) WHERE effective AND change_type <> 'Sletting')
        WINDOW w AS (PARTITION BY org_nr, field, epoch ORDER BY "timestamp", update_id)) WHERE change_type = 'Endring' AND value_from IS DISTINCT FROM value_to)""", A.CDC, _LIVED
)
def sync_changelog(spark, sf):
    """C4-C7"""
    out = replay.change_rows(A.base(spark, sf), replay.until(A.cdc(spark, sf), "2024-01-21"))
    return out.select("org_nr", "change_type", "field", "value_from", "value_to", "update_id")


@register("SELECT org_nr, max(\"timestamp\") AS \"timestamp\", max(update_id) AS update_id FROM cdc GROUP BY org_nr", A.CDC)
def events_latest(spark, sf):
    """A7"""
    return replay.latest_per_key(A.cdc(spark, sf)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# graphs

_NAMES = "names AS (SELECT CAST(s_suppkey AS VARCHAR) AS org_nr, s_name AS name FROM supplier)"


def _suppliers(spark, sf):
    return A.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("org_nr"), F.col("s_name").alias("name"), F.lit("enheter").alias("registry"))


_EGO = """held AS (SELECT * FROM roles WHERE org_nr IN ('3', '5'))"""


def _ego(spark, sf, depth=1):
    seeds = spark.createDataFrame([("3",), ("5",)], "org_nr string")
    return graph.network(seeds, _suppliers(spark, sf), {"roles": A.roles(spark, sf)}, depth)


@register(
    """SELECT node_id, node_type, name, org_nr, person_id FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY rank, node_type, name NULLS LAST) AS rn FROM (
      SELECT concat('o:', org_nr) AS node_id, 'enheter' AS node_type, name, org_nr, CAST(NULL AS VARCHAR) AS person_id, 0 AS rank FROM names WHERE org_nr IN ('3', '5') UNION ALL
      SELECT concat('p:', person_id), 'person', concat_ws(' ', first_name, last_name), NULL, person_id, 3 FROM held WHERE person_id IS NOT NULL UNION ALL
      SELECT concat('o:', entity_org_nr), 'role_holder_entity', entity_name, entity_org_nr, NULL, 4 FROM held WHERE person_id IS NULL AND entity_org_nr IS NOT NULL)) WHERE rn = 1""", A.ROLES.format(0), _NAMES, _EGO
)
def ego_nodes(spark, sf):
    """G1, G2, G4, G7, U4"""
    return _ego(spark, sf)[0]


@register(
    """SELECT concat('p:', person_id) AS "from", concat('o:', org_nr) AS "to", 'role' AS edge_type, role_code, role FROM held WHERE person_id IS NOT NULL UNION ALL
    SELECT concat('o:', entity_org_nr), concat('o:', org_nr), 'entity_role', role_code, role FROM held WHERE person_id IS NULL AND entity_org_nr IS NOT NULL""", A.ROLES.format(0), _EGO
)
def ego_edges(spark, sf):
    """G4, J13"""
    return _ego(spark, sf)[1]


@register(
    """SELECT concat('p:', person_id) AS "from", concat('o:', org_nr) AS "to", 'role' AS edge_type, role_code, role FROM roles r WHERE person_id IN (SELECT person_id FROM held WHERE person_id IS NOT NULL)
    AND org_nr NOT IN ('3', '5') AND org_nr NOT IN (SELECT entity_org_nr FROM held WHERE entity_org_nr IS NOT NULL)""", A.ROLES.format(0), _EGO
)
def interlock_edges(spark, sf):
    """G6, J14, J15"""
    seeds = spark.createDataFrame([("3",), ("5",)], "org_nr string")
    known = _ego(spark, sf)[0].where("org_nr IS NOT NULL").select("org_nr")
    return graph.interlocks(seeds, A.roles(spark, sf), known, _suppliers(spark, sf))[1]


@register("SELECT concat('p:', person_id) AS \"from\", concat('o:', org_nr) AS \"to\", role_code, role_group_code FROM roles WHERE person_id IS NOT NULL AND org_nr IN ('1', '2', '3', '4')", A.ROLES.format(0))
def board_network_edges(spark, sf):
    """G8"""
    return graph.board_network(A.roles(spark, sf), _suppliers(spark, sf), ("1", "2", "3", "4"))[1]


@register(
    """SELECT x.o AS org_a, y.o AS org_b, count(*) AS shared FROM h x JOIN h y ON x.p = y.p AND x.o < y.o GROUP BY ALL""", A.ROLES.format(0),
    "h AS (SELECT DISTINCT concat('o:', org_nr) AS o, person_id AS p FROM roles WHERE person_id IS NOT NULL)",
)
def board_projection(spark, sf):
    """G8"""
    return graph.projection(graph.board_network(A.roles(spark, sf), _suppliers(spark, sf))[1])


# flattening


@register("SELECT c_custkey AS k, CASE WHEN d IS NOT NULL AND c_name IS NOT NULL THEN lower(concat(CAST(d AS VARCHAR), '_', c_name, '_', coalesce(f, 'NA'), '_')) END AS person_id FROM (SELECT *, CASE WHEN c_custkey % 5 > 0 THEN CAST(DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS DATE) END AS d, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS f FROM customer)")
def person_ids(spark, sf):
    """P10"""
    key = F.col("c_custkey")
    born = F.when(key % 5 > 0, F.date_add(F.lit("1960-01-01").cast("date"), (key % 9000).cast("int")))
    return A.table(spark, sf, "customer").select(key.alias("k"), exprs.person_id(born, F.col("c_name"), F.when(key % 4 > 0, F.col("c_mktsegment")), F.lit(None).cast("string")).alias("person_id"))


@register("SELECT DISTINCT concat(p_type, '.someField', p_brand) AS path, lower(replace(regexp_replace(concat(p_type, '.someField', p_brand), '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '.', '_')) AS name FROM part")
def to_snake_values(spark, sf):
    """P6"""
    path = F.concat("p_type", F.lit(".someField"), "p_brand")
    return A.table(spark, sf, "part").select(path.alias("path")).distinct().select("path", exprs.to_snake("path").alias("name"))


@register("SELECT conv_id, string_agg(role, '; ' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id")
def list_flatten(spark, sf):
    """P3"""
    rows = A.table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x.role).alias("roles"))
    return rows.select("conv_id", ingest.cell(F.col("roles"), rows.schema["roles"].dataType).alias("roles"))


@register("SELECT 'employees' AS \"column\", 'int' AS expected, c_mktsegment AS actual FROM customer WHERE c_custkey % 11 = 0 ORDER BY c_custkey LIMIT 20")
def coerce_problems(spark, sf):
    """P5"""
    key = F.col("c_custkey")
    odd = F.when(key % 11 == 0, F.col("c_mktsegment")).otherwise(key.cast("string"))
    return ingest.parse_problems(A.table(spark, sf, "customer").select("c_custkey", odd.alias("antallAnsatte")), key="c_custkey").drop("row")


# store and drift


@register(
    "SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date DESC) > 3 OR snapshot_date < DATE '2000-06-30' - 1000 AS remove FROM available", _AVAILABLE
)
def retention_plan(spark, sf):
    """K7, W6"""
    return store.retention_plan(A.available(spark), 3, 1000, "2000-06-30")


_PREVALENCE = """k AS (SELECT concat(legal_form, '|', CASE WHEN bankrupt THEN 'bankrupt' ELSE 'ordinary' END) AS segment, count(*) AS n, count(parent_org_nr) AS parent_org_nr, count(bankruptcy_date) AS bankruptcy_date, count(liquidation_date) AS liquidation_date FROM entities GROUP BY 1),
 p AS (SELECT segment, path, k, n FROM (""" + " UNION ALL ".join(f"SELECT segment, '{c}' AS path, {c} AS k, n FROM k" for c in ("parent_org_nr", "bankruptcy_date", "liquidation_date")) + ") WHERE k > 0)"


def _prevalence(spark, sf):
    e = A.entities(spark, sf)
    e = e.withColumn("segment", drift.segment(state=F.when(F.col("bankrupt"), "bankrupt").otherwise("ordinary")))
    return drift.prevalence(e.select("segment", "parent_org_nr", "bankruptcy_date", "liquidation_date"), "segment").drop("type")


@register("SELECT segment, path, k, n FROM p", A.ENTITIES, _PREVALENCE)
def field_prevalence(spark, sf):
    """P16, P17, A10"""
    return _prevalence(spark, sf)


@register("SELECT segment, path, k, n FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY (k + 0.5) / (n + 1) DESC, segment) AS r FROM p) WHERE r = 1", A.ENTITIES, _PREVALENCE)
def prevalence_top_segment(spark, sf):
    """W2, A11"""
    return drift.top_segment(_prevalence(spark, sf))


#: Bisections of both tails at once; ``u``, ``s`` and ``t`` turn what lies above the mean around.
_BISECTED = """q AS (SELECT row_number() OVER () AS id, *, k + 0.5 AS a, n - k + 0.5 AS b, lgamma(n + 1.0) - lgamma(k + 0.5) - lgamma(n - k + 0.5) AS front FROM p, (SELECT unnest([0.025, 0.975]) AS tail)),
 r AS (SELECT id, 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high FROM q UNION ALL
  SELECT id, i + 1, CASE WHEN share < tail THEN mid ELSE low END, CASE WHEN share < tail THEN high ELSE mid END FROM (
   SELECT *, CASE WHEN upper THEN 1 - part ELSE part END AS share FROM (
    SELECT *, exp(front + s * ln(u) + t * ln(1 - u)) / s / list_reduce(list_prepend(CAST(1 AS DOUBLE), list_transform(range(400), lambda x: CAST(400 - x AS DOUBLE))),
      lambda f, j: 1 + CASE WHEN j % 2 = 0 THEN (j / 2) * (t - j / 2) / ((s + j - 1) * (s + j)) ELSE -(s + (j - 1) / 2) * (s + t + (j - 1) / 2) / ((s + j - 1) * (s + j)) END * u / f) AS part FROM (
     SELECT *, CASE WHEN upper THEN 1 - mid ELSE mid END AS u, CASE WHEN upper THEN b ELSE a END AS s, CASE WHEN upper THEN a ELSE b END AS t FROM (
      SELECT *, mid > (a + 1) / (a + b + 2) AS upper FROM (SELECT r.id, i, low, high, (low + high) / 2 AS mid, tail, front, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM r JOIN q USING (id) WHERE i < 50))))))"""


@register(
    """SELECT segment, path, k, n, (k + 0.5) / (n + 1) AS theta, round(max((low + high) / 2) FILTER (tail < 0.5), 8) AS theta_low, round(max((low + high) / 2) FILTER (tail > 0.5), 8) AS theta_high
    FROM q JOIN r USING (id) WHERE i = 50 GROUP BY segment, path, k, n""", "RECURSIVE " + A.ENTITIES, _PREVALENCE, _BISECTED,
)
def prevalence_interval(spark, sf):
    """Jeffreys' interval, bounds to eight places"""
    return drift.with_interval(_prevalence(spark, sf)).withColumns({c: F.round(c, 8) for c in ("theta_low", "theta_high")})


@register("SELECT ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY event_id) AS r FROM events) WHERE r <= 5")
def stratified_sample(spark, sf):
    """S25"""
    rows = A.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return drift.stratified(rows, "day", "event_type", 5, "event_id").select("ts", "event_id", "event_type")
