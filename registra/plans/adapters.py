"""Registry-shaped tables made from the driver's tables, each as a DataFrame and as a CTE for the oracle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_DATES = ("1996-12-31", "1997-12-31", "1998-12-31", "1999-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ENTITIES = """entities AS (
  SELECT concat('9', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS org_nr, c_name AS name, c_mktsegment AS legal_form,
    lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS municipality_code, CAST(c_custkey % 500 AS INTEGER) AS employees, c_custkey % 17 = 0 AS bankrupt,
    CASE WHEN c_custkey % 3 = 0 THEN concat('9', lpad(CAST((c_custkey - c_custkey % 10) / 10 AS BIGINT)::VARCHAR, 8, '0')) END AS parent_org_nr,
    CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS founding_date,
    CAST(DATE '1995-01-01' + CAST(c_custkey % 700 AS INTEGER) AS DATE) AS registration_date,
    CASE WHEN c_custkey % 17 = 0 THEN CAST(DATE '1996-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS DATE) END AS bankruptcy_date,
    CASE WHEN c_custkey % 23 = 0 THEN CAST(DATE '1996-01-01' + CAST(c_custkey % 1300 AS INTEGER) AS DATE) END AS liquidation_date,
    CASE WHEN c_custkey % 2 = 0 THEN 'enheter' ELSE 'underenheter' END AS registry FROM customer)"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("c_custkey"), lambda base, m: F.date_add(F.lit(base).cast("date"), (F.col("c_custkey") % m).cast("int"))
    org = lambda c: F.concat(F.lit("9"), F.lpad(c.cast("string"), 8, "0"))
    return table(spark, sf_dir, "customer").select(
        org(key).alias("org_nr"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("legal_form"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("municipality_code"), (key % 500).cast("int").alias("employees"), (key % 17 == 0).alias("bankrupt"),
        F.when(key % 3 == 0, org(F.expr("c_custkey div 10"))).alias("parent_org_nr"), day("1995-01-01", 2000).alias("founding_date"),
        day("1995-01-01", 700).alias("registration_date"), F.when(key % 17 == 0, day("1996-01-01", 1500)).alias("bankruptcy_date"),
        F.when(key % 23 == 0, day("1996-01-01", 1300)).alias("liquidation_date"), F.when(key % 2 == 0, "enheter").otherwise("underenheter").alias("registry"),
    )


SNAPSHOTS = f"""snapshots AS (
  SELECT CAST(o_custkey AS VARCHAR) AS org_nr, d AS snapshot_date, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
    arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority, CAST(count(*) AS INTEGER) AS orders
  FROM orders, (SELECT unnest([{", ".join(f"DATE '{d}'" for d in SNAPSHOT_DATES)}]) AS d)
  WHERE CAST(o_orderdate AS DATE) > d - 365 AND CAST(o_orderdate AS DATE) <= d GROUP BY o_custkey, d)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly states of customers: their latest order's status and priority, and how many orders they made."""
    days = F.array(*[F.lit(d).cast("date") for d in SNAPSHOT_DATES])
    rows = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    rows = rows.withColumn("snapshot_date", F.explode(F.filter(days, lambda d: (F.col("day") > F.date_sub(d, 365)) & (F.col("day") <= d))))
    order = F.struct("o_orderdate", "o_orderkey")
    return rows.groupBy(F.col("o_custkey").cast("string").alias("org_nr"), "snapshot_date").agg(
        F.max_by("o_orderstatus", order).alias("status"), F.max_by("o_orderpriority", order).alias("priority"), F.count("*").cast("int").alias("orders")
    )


def available(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in SNAPSHOT_DATES], "d string").select(F.col("d").cast("date").alias("snapshot_date"))


CDC = """cdc AS (
  SELECT event_id AS update_id, CAST(user_id AS VARCHAR) AS org_nr,
    CASE event_type WHEN 'signup' THEN 'Ny' WHEN 'error' THEN 'Sletting' ELSE 'Endring' END AS change_type, ts AS "timestamp",
    event_type AS v_name, json_extract_string(props, '$.k') AS v_k FROM events),
 base AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS org_nr, concat('user ', CAST(user_id AS VARCHAR)) AS name, 0 AS employees FROM events WHERE user_id % 3 <> 0)"""


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a change feed: signups insert, errors delete, others patch a name and a number."""
    kind = F.when(F.col("event_type") == "signup", "Ny").when(F.col("event_type") == "error", "Sletting").otherwise("Endring")
    patch = lambda field, v: F.struct(F.lit("replace").alias("operation"), F.lit(field).alias("field"), v.alias("new_value"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("update_id"), F.col("user_id").cast("string").alias("org_nr"), kind.alias("change_type"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.array(patch("navn", F.col("event_type")), patch("antallAnsatte", F.get_json_object("props", "$.k"))).alias("changes"),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    rows = table(spark, sf_dir, "events").where("user_id % 3 <> 0").select(user.alias("org_nr"), F.concat(F.lit("user "), user).alias("name"), F.lit(0).alias("employees"))
    return rows.distinct()


ROLES = """roles AS (
  SELECT DISTINCT org_nr, role_group_code, role_group, role_code, role, first_name, CAST(NULL AS VARCHAR) AS middle_name, last_name, birth_date, deceased, entity_org_nr, entity_name,
    resigned, deregistered, ordering, elected_by, group_modified,
    CASE WHEN birth_date IS NOT NULL AND last_name IS NOT NULL THEN lower(concat(CAST(birth_date AS VARCHAR), '_', last_name, '_', coalesce(first_name, 'NA'), '_')) END AS person_id
  FROM (SELECT CAST(l_suppkey AS VARCHAR) AS org_nr,
    CASE WHEN l_linenumber % 7 = 6 THEN 'REVI' WHEN l_linenumber % 7 = 5 THEN 'DAGL' ELSE 'STYR' END AS role_group_code, CAST(NULL AS VARCHAR) AS role_group,
    CASE WHEN l_linenumber % 7 = 6 THEN 'REVI' WHEN l_linenumber % 7 = 5 THEN 'DAGL' WHEN l_returnflag = 'A' THEN 'LEDE' WHEN l_returnflag = 'N' THEN 'MEDL' ELSE 'VARA' END AS role_code,
    CAST(NULL AS VARCHAR) AS role, CASE WHEN l_linenumber % 7 <> 6 THEN concat('F', CAST(o_custkey AS VARCHAR)) END AS first_name,
    CASE WHEN l_linenumber % 7 <> 6 THEN concat('L', CAST(o_custkey AS VARCHAR)) END AS last_name,
    CASE WHEN l_linenumber % 7 <> 6 THEN CAST(DATE '1950-01-01' + CAST(o_custkey % 9000 AS INTEGER) AS DATE) END AS birth_date, l_quantity > 49 AS deceased,
    CASE WHEN l_linenumber % 7 = 6 THEN CAST(o_custkey AS VARCHAR) END AS entity_org_nr, CASE WHEN l_linenumber % 7 = 6 THEN concat('E', CAST(o_custkey AS VARCHAR)) END AS entity_name,
    l_linestatus = 'F' AND l_quantity > 40 AS resigned, CAST(NULL AS BOOLEAN) AS deregistered, l_linenumber AS ordering, CASE WHEN l_quantity < 5 THEN 'AREP' END AS elected_by,
    CAST(NULL AS DATE) AS group_modified FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > {0}))"""


#: What tells a role's columns besides the holder, where it is not a column of its own name.
_FROM_NUMBER = ("role_group_code", "ordering")


def roles(
    spark: SparkSession, sf_dir: str, above: int = 0, by_org: bool = False, columns: Sequence[str] | None = None, org: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """Suppliers' order lines as roles: customers hold them; every seventh line is an auditor.

    Rows that are told apart by all columns are so by the few these come from, which alone are shuffled; ``by_org`` to
    where their organisation's others are, so that grouping by ``org_nr`` shuffles nothing more. ``columns`` are those
    asked for, told apart by what they come from; ``org`` makes an organisation's number from a supplier's.
    """
    line, quantity = F.col("l_linenumber") % 7, F.col("l_quantity")
    held = F.when(F.col("l_returnflag") == "A", "LEDE").when(F.col("l_returnflag") == "N", "MEDL").otherwise("VARA")
    every = {
        "role_code": F.when(line == 6, "REVI").when(line == 5, "DAGL").otherwise(held), "deceased": quantity > 49,
        "resigned": (F.col("l_linestatus") == "F") & (quantity > 40), "elected_by": F.when(quantity < 5, "AREP"),
    }
    # all that most columns take from a line's number is whether it is an auditor's
    number = "l_linenumber" if columns is None or set(columns) & set(_FROM_NUMBER) else "auditor"
    own = [F.col("l_linenumber") if number == "l_linenumber" else (line == 6).alias("auditor")]
    own += [c.alias(n) for n, c in every.items() if columns is None or n in columns]
    lines = table(spark, sf_dir, "lineitem").where(quantity > above).select("l_orderkey", "l_suppkey", *own)
    # orders are unique by key, so hashing them needs no sort of the lines, and is the plan at every size
    customers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").hint("shuffle_hash")
    # a line without a number has no holder
    who = F.when(F.col(number).isNotNull(), F.col("o_custkey"))
    told = F.col(number) if number == "l_linenumber" else F.when(who.isNotNull(), F.col(number)).alias(number)
    rows = lines.join(customers, "l_orderkey").select(org(F.col("l_suppkey").cast("string")).alias("org_nr"), told, *[n for n in every if n in lines.columns], who.alias("holder"))
    rows = (rows.repartition("org_nr") if by_org else rows).distinct()
    auditor = line == 6 if number == "l_linenumber" else F.col("auditor")
    who, text = F.col("holder").cast("string"), lambda: F.lit(None).cast("string")
    born = F.when(~auditor, F.date_add(F.lit("1950-01-01").cast("date"), (F.col("holder") % 9000).cast("int")))
    first, last = F.when(~auditor, F.concat(F.lit("F"), who)), F.when(~auditor, F.concat(F.lit("L"), who))
    from ..functions.exprs import person_id

    made = {
        "org_nr": F.col("org_nr"), "role_group_code": F.when(line == 6, "REVI").when(line == 5, "DAGL").otherwise("STYR"), "role_group": text(), "role_code": F.col("role_code"),
        "role": text(), "first_name": first, "middle_name": text(), "last_name": last, "birth_date": born, "deceased": F.col("deceased"), "entity_org_nr": F.when(auditor, who),
        "entity_name": F.when(auditor, F.concat(F.lit("E"), who)), "resigned": F.col("resigned"), "deregistered": F.lit(None).cast("boolean"), "ordering": F.col("l_linenumber"),
        "elected_by": F.col("elected_by"), "group_modified": F.lit(None).cast("date"), "person_id": person_id(born, last, first, text()),
    }
    return rows.select(*[c.alias(n) for n, c in made.items() if columns is None or n in columns])


CHANGELOG = """changelog AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp", CAST(user_id AS VARCHAR) AS org_nr, CASE WHEN user_id % 2 = 0 THEN 'enheter' ELSE 'roller' END AS registry,
    CASE event_type WHEN 'signup' THEN 'entry' WHEN 'error' THEN 'exit' ELSE 'change' END AS change_type,
    CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type END AS field, json_extract_string(props, '$.k') AS value_to, event_id AS update_id, CAST(ts AS DATE) AS sync_date FROM events)"""


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "entry").when(F.col("event_type") == "error", "exit").otherwise("change")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("user_id").cast("string").alias("org_nr"), F.when(F.col("user_id") % 2 == 0, "enheter").otherwise("roller").alias("registry"),
        kind.alias("change_type"), F.when(~F.col("event_type").isin("signup", "error"), F.col("event_type")).alias("field"), F.get_json_object("props", "$.k").alias("value_to"),
        F.col("event_id").alias("update_id"), F.col("ts").cast("date").alias("sync_date"),
    )


ANNOTATIONS = """annotations AS (
  SELECT CAST(conv_id AS VARCHAR) AS org_nr, CAST(turn AS INTEGER) AS position, CASE WHEN role = 'user' THEN 'FADR' WHEN role = 'assistant' THEN 'NAVN' ELSE upper(role) END AS infotype,
    md5(text) AS tekst, CAST(NULL AS VARCHAR) AS innfoert_dato FROM conversations)"""


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("role") == "user", "FADR").when(F.col("role") == "assistant", "NAVN").otherwise(F.upper("role"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("org_nr"), F.col("turn").cast("int").alias("position"), kind.alias("infotype"), F.md5(F.col("text").cast("binary")).alias("tekst"), F.lit(None).cast("string").alias("innfoert_dato")
    )
