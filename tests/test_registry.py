"""Operators of the registry on small inline tables."""

import datetime
import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.functions import dictionaries, exprs, schema
from registra.operators import changes, diff, drift, governance, graph, label, lookup, panel, replay
from registra.plans import adapters
from registra.sources import ingest, ranges, updates
from registra.sources.store import Store, retention_plan
from registra.streaming import sync


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def test_org_numbers(spark):
    good = ["923609016", "984851006", "974760673", "937884117", "971524960"]
    bad = ["123456789", "984851007", "12345", "", "abcdefghi", "000000000", "100000000", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "n string").select("n", exprs.valid_org_nr("n").alias("v"))
    assert {r.n for r in df.collect() if r.v} == set(good)


@pytest.mark.parametrize("path, name", [("antallAnsatte", "antall_ansatte"), ("naeringskode1.kode", "naeringskode1_kode"), ("navn", "navn"), ("erIKonsern", "er_ikonsern")])
def test_snake_names(spark, path, name):
    assert exprs.snake_name(path) == name
    assert spark.range(1).select(exprs.to_snake(F.lit(path))).first()[0] == name


def test_dictionary_has_101_columns():
    assert len(schema.FIELDS) == 103 and len(schema.COLUMN_TYPES) == 101
    assert len(dictionaries.ROLE_TYPES) == 24 and len(dictionaries.ROLE_GROUPS) == 15 and len(dictionaries.INFOTYPES) == 7


def test_periods(spark):
    target = lambda *a: [str(r[0]) for r in panel.period_targets(spark, *a).orderBy("target_date").collect()]
    assert target("2023-03-15", "2025-09-01", "year") == ["2023-12-31", "2024-12-31", "2025-12-31"]
    dates = spark.createDataFrame([("2024-07-01",), ("2025-01-01",)], "d string").select(F.col("d").cast("date").alias("snapshot_date"))
    targets = spark.createDataFrame([("2024-06-30",), ("2024-12-31",), ("2025-12-31",)], "d string").select(F.col("d").cast("date").alias("target_date"))
    assert [(str(a), str(b)) for a, b, _ in rows(panel.locf(targets, dates))] == [("2024-12-31", "2024-07-01"), ("2025-12-31", "2025-01-01")]
    assert panel.locf(targets, dates, 200).count() == 1
    parsed = spark.createDataFrame([("2024",), ("2024-07",), ("2024-Q3",), ("2024-07-02",), ("x",)], "p string").select(exprs.parse_period("p"))
    assert [str(r[0]) for r in parsed.collect()] == ["2024-01-01", "2024-07-01", "2024-07-01", "2024-07-02", "None"]


SNAPSHOT = "org_nr string, name string, employees int"


def test_snapshot_events(spark):
    old = spark.createDataFrame([("1", "Alpha", 5), ("2", "Beta AS", 7), ("3", "Gone", None)], SNAPSHOT)
    new = spark.createDataFrame([("1", "Alpha", 6), ("2", "Beta Rebranded AS", None), ("4", "New", 1)], SNAPSHOT)
    out = rows(diff.snapshot_events(old, new, "2024-07-01"), "org_nr", "event_type", "field", "value_from", "value_to")
    assert out == sorted([
        ("1", "change", "employees", "5", "6"), ("2", "change", "name", "Beta AS", "Beta Rebranded AS"), ("2", "change", "employees", "7", None),
        ("3", "exit", None, None, None), ("4", "entry", None, None, None),
    ], key=str)
    assert diff.snapshot_events(old, old, "2024-07-01").count() == 0


def role(**change):
    base = dict(
        org_nr="111", role_group_code="STYR", role_group="Board", role_code="LEDE", role="Chair", first_name="Jan", middle_name=None, last_name="Aarrestad",
        birth_date=datetime.date(1951, 7, 16), deceased=False, entity_org_nr=None, entity_name=None, resigned=False, deregistered=False, ordering=0, elected_by=None,
        group_modified=datetime.date(2024, 1, 1), person_id="1951-07-16_aarrestad_jan_",
    )
    return tuple((base | change)[f.name] for f in schema.ROLES)


def test_role_changes(spark):
    table = lambda *r: spark.createDataFrame(list(r), schema.ROLES)
    what = lambda o, n: rows(diff.role_changes(o, n, "t"), "change_type", "field", "value_from", "value_to")
    assert what(table(role()), table(role())) == []
    assert {r[0] for r in what(None, table(role()))} == {"entry"} and all(r[3] is not None for r in what(None, table(role())))
    assert what(table(role()), table(role(deceased=True))) == [("change", "deceased", "FALSE", "TRUE")]
    assert what(table(role()), table(role(elected_by="AREP"))) == [("change", "elected_by", None, "AREP")]
    auditor = lambda n: role(role_group_code="REVI", role_code="REVI", person_id=None, entity_org_nr=n, birth_date=None)
    assert {r[0] for r in what(table(auditor("987654321")), table(auditor("912345678")))} == {"exit", "entry"}
    legacy = table(role()).drop("deceased", "deregistered", "ordering", "elected_by")
    assert ("change", "deceased", None, "FALSE") in what(legacy, table(role()))
    assert rows(diff.role_key(table(role(), auditor("987654321"))), "role_key") == [("111|REVI|REVI|entity:987654321",), ("111|STYR|LEDE|1951-07-16_aarrestad_jan_",)]


def test_unknown_holders_across_extracts(spark):
    """One that goes is one exit, whoever comes before it; of alike ones as many go as there are fewer."""
    unknown = lambda **k: role(person_id=None, birth_date=None, last_name=None, **k)
    table = lambda *r: spark.createDataFrame(list(r), schema.ROLES)
    held = [unknown(first_name=n, ordering=i) for i, n in enumerate(["A", "B", "C", "C", "C", None, None])] + [unknown(org_nr="222", first_name="A"), role()]
    for n in range(len(held)):
        out = diff.role_changes(table(*held), table(*held[:n], *held[n + 1 :]), "t").collect()
        assert {r.change_type for r in out} == {"exit"} and len({r.role_key for r in out}) == 1
        assert sum(r.field == "role" for r in out) == 1
        back = diff.role_changes(table(*held[:n], *held[n + 1 :]), table(*held), "t").collect()
        assert {r.change_type for r in back} == {"entry"} and sorted(r.field for r in back) == sorted(r.field for r in out)
    alike = [unknown(first_name="C")] * 5
    out = diff.role_changes(table(*alike, role()), table(*alike[:2], role()), "t").where("field = 'role'").collect()
    assert [r.change_type for r in out] == ["exit"] * 3
    assert diff.role_changes(table(*alike, *held), table(*held[::-1], *alike), "t").count() == 0


def test_board_and_survival(spark):
    table = spark.createDataFrame([role(), role(role_code="MEDL", elected_by="AREP", person_id="x"), role(role_code="VARA", resigned=True, person_id="y"), role(role_group_code=None, person_id="z")], schema.ROLES)
    one = governance.board_summary(table).first()
    assert (one.board_size, one.n_chair, one.n_members, one.n_alternates, one.n_employee_elected, one.has_ceo) == (2, 1, 1, 0, 1, False)
    data = spark.createDataFrame([("2015-01-01", None, None), ("2015-01-01", "2023-11-30", None), ("2015-01-01", "2020-06-01", "2020-03-01"), ("2026-01-01", None, None)], "founding_date string, bankruptcy_date string, liquidation_date string")
    out = governance.survival(data, "2025-01-01").collect()
    assert [r.event for r in out] == [0, 1, 1, 0] and str(out[2].exit_date) == "2020-03-01" and out[3].duration_years is None
    with pytest.raises(ValueError):
        governance.survival(data, "2025-01-01", entry="nothing")


def fold(base, events):
    """Replay row by row."""
    state, counts = {k: dict(v) for k, v in base.items()}, [0, 0, 0]
    for _, org, kind, _, patches in sorted(events, key=lambda e: (e[3], e[0])):
        if kind == "Ny" and org not in state:
            state[org], counts[0] = {"name": None, "employees": None}, counts[0] + 1
        elif kind == "Endring" and org in state:
            counts[1] += 1
        elif kind == "Sletting" and org in state:
            del state[org]
            counts[2] += 1
            continue
        else:
            continue
        for _, field, value in patches:
            column = replay.field_column(field, ["name", "employees"])
            if column:
                state[org][column] = value if column == "name" or value is None else int(value)
    return state, counts


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_fold(spark, seed):
    rnd = random.Random(seed)
    base = {str(i): {"name": f"n{i}", "employees": i} for i in range(12)}
    events = []
    for i in range(250):
        patches = [("replace", rnd.choice(["navn", "antallAnsatte", "unknown"]), rnd.choice(["1", "2", None])) for _ in range(rnd.randint(0, 2))]
        events.append((i, str(rnd.randint(0, 20)), rnd.choice(["Ny", "Endring", "Endring", "Sletting", "Ukjent"]), datetime.datetime(2024, 1, 1 + rnd.randint(0, 9)), patches))
    b = spark.createDataFrame([(k, v["name"], v["employees"]) for k, v in base.items()], SNAPSHOT)
    u = spark.createDataFrame(events, schema.UPDATES)
    state, counts = fold(base, events)
    assert rows(replay.replay(b, u)) == sorted([(k, v["name"], v["employees"]) for k, v in state.items()], key=str)
    assert list(replay.counters(replay.lived(b, u)).first()) == counts
    assert replay.until(u, "2024-01-05").count() <= replay.until(u, "2024-01-05", True).count()


@pytest.mark.parametrize("seed", [3, 4])
def test_replay_at_many_dates(spark, seed):
    """Every date's state as its own replay has it, ties in time and lives that end and begin again included."""
    rnd = random.Random(seed)
    base = spark.createDataFrame([(str(i), f"n{i}", i) for i in range(10)], SNAPSHOT)
    events = []
    for i in range(160):
        patches = [("replace", rnd.choice(["navn", "antallAnsatte", "unknown"]), rnd.choice(["1", "2", None])) for _ in range(rnd.randint(0, 3))]
        at = datetime.datetime(2024, 1, 1 + rnd.randint(0, 9), rnd.choice([0, 0, 7])) if i % 40 else None
        events.append((i, str(rnd.randint(0, 14)), rnd.choice(["Ny", "Endring", "Endring", "Sletting", "Ukjent"]), at, rnd.choice([patches, patches, None])))
    updates = spark.createDataFrame(events, schema.UPDATES)
    dates = ["2023-12-31", "2024-01-01", "2024-01-04", "2024-01-05", "2024-01-09", "2024-02-01"]
    for inclusive in (False, True):
        found = replay.replay_dates(base, updates, dates, inclusive_day=inclusive).collect()
        for date in dates:
            mine = sorted(((r.org_nr, r.name, r.employees) for r in found if str(r.target_date) == date), key=str)
            assert mine == rows(replay.replay(base, updates, date, inclusive_day=inclusive), "org_nr", "name", "employees"), (date, inclusive)
    assert replay.replay_dates(base.limit(0), updates.limit(0), dates).count() == 0


def test_patch_fields():
    columns = ["org_nr", "employees", "some_custom_field", "business_city"]
    assert replay.field_column("antallAnsatte", columns) == "employees"
    assert replay.field_column("forretningsadresse_poststed", columns) == "business_city"
    assert replay.field_column("someCustomField", columns) == "some_custom_field"
    assert replay.field_column("unknown", columns) is None


def leaves(field, value):
    if isinstance(value, dict):
        return [x for k, v in sorted(value.items()) for x in leaves(f"{field}_{k}", v)]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in leaves(f"{field}_{i}", v)]
    return [(field, None if value is None else str(value).upper() if isinstance(value, bool) else value if isinstance(value, str) else json.dumps(value))]


def patch_rows(found):
    """Patches row by row."""
    out = []
    for p in found:
        name = lambda key: (p.get(key) or "").strip("/").replace("/", "_")  # noqa: B023, E731
        if p.get("op") in ("move", "copy"):
            out += [("remove", name("from"), None)] * (p["op"] == "move") + [(p["op"], name("path"), None)]
        elif p.get("op") == "remove" or p.get("value") == []:
            out.append((p.get("op"), name("path"), None))
        else:
            out += [(p.get("op"), f, v) for f, v in leaves(name("path"), p.get("value"))]
    return out


def flattened(spark, texts):
    return [[tuple(p) for p in r.p] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(updates.patches(F.col("t")).alias("p")).collect()]


def test_patches(spark):
    patches = [
        {"op": "replace", "path": "/navn", "value": "A"}, {"op": "add", "path": "/adresse", "value": {"by": "Oslo", "linjer": ["x", "y"]}}, {"op": "remove", "path": "/mobil"},
        {"op": "replace", "path": "/paategninger", "value": []}, {"op": "move", "path": "/b", "from": "/a"}, {"op": "add", "path": "/f", "value": True},
    ]
    expected = [
        ("replace", "navn", "A"), ("add", "adresse_by", "Oslo"), ("add", "adresse_linjer_0", "x"), ("add", "adresse_linjer_1", "y"), ("remove", "mobil", None),
        ("replace", "paategninger", None), ("remove", "a", None), ("move", "b", None), ("add", "f", "TRUE"),
    ]
    assert patch_rows(patches) == expected and flattened(spark, [json.dumps(patches), None, "", "{}", "[", "[]"]) == [expected, [], [], [], [], []]
    rnd = random.Random(2)

    def value(depth):
        kind = rnd.randrange(9 if depth else 6)
        if kind < 6:
            return [None, True, "é \" \n", 12345678901, -1.25, ""][kind]
        return [value(depth - 1) for _ in range(rnd.randrange(3))] if kind == 6 else {rnd.choice(["a", "b", "æ_1", "C"]): value(depth - 1) for _ in range(rnd.randrange(4))}

    every = [[{"op": rnd.choice(["add", "replace", "remove", "move", "copy"]), "path": rnd.choice(["/x", "/x/y/", "z"]), "from": "/o/p", "value": value(5)} for _ in range(3)] for _ in range(60)]
    assert flattened(spark, map(json.dumps, every)) == [patch_rows(p) for p in every]
    deep = flattened(spark, [json.dumps([{"op": "add", "path": "/d", "value": [[[[[[[["x"]]]]]]]]}])])
    assert deep == [[("add", "d" + "_0" * updates.LEVELS, '[["x"]]')]]


def test_ingest(spark, tmp_path):
    raw = {
        "organisasjonsnummer": "923609016", "navn": "X", "antallAnsatte": 5, "registreringsdatoEnhetsregisteret": "1995-03-12", "organisasjonsform": {"kode": "ASA", "_links": {"self": "u"}},
        "kapital": {"antallAksjer": 2556807512}, "aktivitet": ["a", "b"], "paategninger": [], "nyttFelt": "z", "konkurs": False, "_links": {"self": "u"},
    }
    path = tmp_path / "e.json"
    path.write_text(json.dumps([raw]))
    out = ingest.parse_entities(ingest.read_json(spark, str(path)))
    one = out.first()
    assert (one.org_nr, one.employees, str(one.registration_date), one.legal_form, one.capital_shares, one.activity, one.nytt_felt, one.bankrupt) == ("923609016", 5, "1995-03-12", "ASA", 2556807512.0, "a; b", "z", False)
    assert one.annotations is None and set(schema.COLUMN_TYPES) <= set(out.columns) and not any("link" in c for c in out.columns)
    flat = spark.createDataFrame([("21408",), ("not_a_number",), (None,)], "antallAnsatte string")
    assert rows(ingest.parse_problems(flat), "column", "expected", "actual") == [("employees", "int", "not_a_number")]
    csv = tmp_path / "e.csv"
    csv.write_text('organisasjonsnummer,navn,antallAnsatte,konkurs\n999999999,"A, B",5,FALSE\n')
    one = ingest.tidy(ingest.read_csv(spark, str(csv))).first()
    assert (one.org_nr, one.name, one.employees, one.bankrupt) == ("999999999", "A, B", 5, False)


def records_by_ranges(path, size, is_json):
    """What ranges of so many bytes find, their beginnings summed up one after the other."""
    system, name = ranges._system(path)
    within = depth = 0
    out = []
    for start in range(0, ranges.files_of(path)[0][1], size):
        find = ranges._json_elements if is_json else ranges._csv_records
        out += [x.decode() for x in find(system, name, start, size, within, depth)]
        quotes, outside, inside = ranges._counted(system, name, start, size, is_json)
        depth += inside if within else outside
        within = (within + quotes) % 2
    return out


def test_large_files_in_ranges(spark, tmp_path):
    """Ranges that cut fields, quotes, escapes and characters anywhere give what one task reads."""
    rnd = random.Random(6)
    bits = ["a", '"', '""', ",", "\n", "\r\n", "\\", '\\"', "é", "日本", " ", "{", "}", "[", "]", "x" * 90, ""]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randrange(6)))
    table = [["org", "navn", "b.c", 'd "e"\nf'], *([f"id{i}", text(), text(), "y"] for i in range(120))]
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    (tmp_path / "csv").mkdir()
    for part, ending in ((0, "\n"), (1, "\r\n")):
        lines = [",".join(map(quoted, r)) for r in [table[0], *table[1 + 60 * part : 61 + 60 * part]]]
        (tmp_path / "csv" / f"{part}.csv").write_bytes((ending.join(lines) + (ending if part else "")).encode())
        for size in (1, 7, 64, 100_000):
            assert records_by_ranges(f"file://{tmp_path}/csv/{part}.csv", size, False) == lines[1:]
    shown = lambda df: sorted(map(str, df.collect()))
    whole, cut = (ingest.read_csv(spark, f"file://{tmp_path}/csv", range_bytes=n) for n in (None, 1500))
    assert cut.columns == whole.columns == table[0] and shown(cut) == shown(whole) and whole.count() == 120
    rows = [{"id": i, "t": text(), "n": {"a": text(), "b": [{"c": text()}, {}]}, **({"x": text()} if i % 3 else {})} for i in range(90)]
    path, kind = f"file://{tmp_path}/e.json", "id long, t string, n struct<a: string, b: array<struct<c: string>>>, x string"
    for indent in (None, 1):
        (tmp_path / "e.json").write_text(json.dumps(rows, ensure_ascii=False, indent=indent))
        for size in (1, 5, 61, 100_000):
            assert [json.loads(x) for x in records_by_ranges(path, size, True)] == rows
    whole = shown(ingest.read_json(spark, path).select("id", "t", "n", "x"))
    assert shown(ingest.read_json(spark, path, T.StructType.fromDDL(kind), range_bytes=2500)) == whole
    assert shown(ingest.read_json(spark, path, range_bytes=5000).select("id", "t", "n", "x")) == whole
    (tmp_path / "z.csv.gz").write_bytes(b"x")
    with pytest.raises(ValueError):
        ingest.read_csv(spark, f"file://{tmp_path}/z.csv.gz", range_bytes=10)


def test_roles_are_told_apart_by_few_columns(spark, tmp_path):
    """The role table's rows are distinct by the columns they come from, and nothing wider is shuffled."""
    line = "1L AS l_orderkey, 7L AS l_suppkey, {n} AS l_linenumber, {q}D AS l_quantity, '{f}' AS l_returnflag, 'F' AS l_linestatus"
    told = [("5", 10, "A"), ("5", 11, "N"), ("6", 10, "A"), ("1", 10, "A"), ("1", 11, "A"), ("1", 45, "A"), ("1", 50, "A"), ("1", 3, "A"), ("1", 10, "X"), ("CAST(NULL AS int)", 10, "A")]
    path = f"file://{tmp_path}"
    spark.sql(" UNION ALL ".join("SELECT " + line.format(n=n, q=q, f=f) for n, q, f in told)).write.parquet(f"{path}/lineitem.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 4L AS o_custkey UNION ALL SELECT 1L, 5L").write.parquet(f"{path}/orders.parquet")
    got = adapters.roles(spark, path)
    assert got.count() == got.distinct().count() == 2 * (1 + 1 + 5) + 1
    assert got.where("ordering IS NULL AND first_name IS NULL AND entity_org_nr IS NULL AND role_code = 'LEDE'").count() == 1
    assert "hashpartitioning(org_nr" not in got._jdf.queryExecution().executedPlan().toString()
    spark.sql("SELECT 1L AS o_orderkey, 4L AS o_custkey UNION ALL SELECT 1L, CAST(NULL AS long)").write.mode("overwrite").parquet(f"{path}/orders.parquet")
    for some in (["org_nr", "role_code", "first_name", "person_id", "entity_org_nr", "resigned"], ["org_nr", "ordering", "person_id", "entity_org_nr"]):
        few = adapters.roles(spark, path, columns=some)
        assert set(few.columns) == set(some) and sorted(map(str, few.select(*some).collect())) == sorted(map(str, adapters.roles(spark, path).select(*some).distinct().collect()))
    assert adapters.roles(spark, path, columns=["org_nr"], org=lambda c: F.lpad(c, 3, "0")).first().org_nr == "007"


def test_few_seeds_go_to_the_lines(spark):
    """A network around a few seeds: lines of other organisations are not shuffled for the seeds' own roles, and roles are
    told apart by narrow columns."""
    from registra.plans import further

    plan = further.network_nodes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert "hashpartitioning(person_id" not in plan and not [x for x in shuffles if "first_name" in x and "role_code" in x]
    assert plan.count("LeftSemi, BuildRight") >= 4


def test_small_ranges_share_tasks(spark, tmp_path):
    """Tasks don't grow in number with ranges of a few bytes; neither do bytes that are read beyond a range."""
    rows = [{"id": i, "t": "x" * (i % 40)} for i in range(2000)]
    (tmp_path / "e.json").write_text(json.dumps(rows))
    cut = ranges.records(spark, f"file://{tmp_path}/e.json", True, 50)
    assert cut.rdd.getNumPartitions() <= 65 and sorted(json.loads(r[0])["id"] for r in cut.collect()) == list(range(2000))
    files = [("a", 64_000_000), ("b", 10)]
    assert ranges.shared(files, 5_000, 64) == (200, 65) and ranges.shared(files, 32 << 20, 64) == (1, 3)
    assert ranges.shared([(str(i), 10) for i in range(10_000)], 5_000, 64) == (1, 64)


def test_roles_and_signing(spark):
    nested = {"organisasjonsnummer": "1", "rollegrupper": [{"type": {"kode": "STYR"}, "sistEndret": "2024-01-01", "roller": [
        {"type": {"kode": "LEDE"}, "person": {"fodselsdato": "1951-07-16", "navn": {"fornavn": "Jan", "etternavn": "Aarrestad"}, "erDoed": False}, "rekkefolge": 1},
        {"type": {"kode": "REVI"}, "enhet": {"organisasjonsnummer": "2", "navn": ["Rev", "AS"]}, "fratraadt": True}]}, {"type": {"kode": "DAGL"}, "roller": []}]}
    df = spark.read.schema(ingest.ROLE_INPUT).json(spark.sparkContext.parallelize([json.dumps(nested)]))
    assert rows(ingest.flatten_roles(df), "role", "person_id", "entity_name", "resigned", "deregistered") == [("Auditor", None, "Rev AS", True, None), ("Chair of the Board", "1951-07-16_aarrestad_jan_", None, False, None)]
    signing = {"organisasjonsnummer": "1", "enhet": {"navn": "X"}, "signeringsKombinasjon": {"kombinasjon": [
        {"kombinasjonsId": "1", "kode": "A", "personRolleKombinasjon": [{"navn": "N", "fodselsdato": "16.07.1951", "rolle": {"kode": "LEDE"}}]}, {"kombinasjonsId": "2"}]}}
    df = spark.read.schema(ingest.SIGNING_INPUT).json(spark.sparkContext.parallelize([json.dumps(signing)]))
    out = ingest.flatten_signing(df, "signatur")
    assert [f.name for f in out.schema] == [f.name for f in schema.SIGNING]
    assert rows(out, "combination_id", "name", "birth_date") == [("1", "N", datetime.date(1951, 7, 16)), ("2", None, None)]


def test_store_and_sync(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/data")
    first = spark.createDataFrame([("1", "A", 1), ("2", "B", 2)], SNAPSHOT)
    assert store.write_snapshot(first, "enheter", "2024-01-01") and not store.write_snapshot(first, "enheter", "2024-01-01")
    store.write_snapshot(first.withColumn("extra", F.lit("x")), "enheter", "2024-07-01")
    assert [str(s[0]) for s in store.snapshots("enheter")] == ["2024-01-01", "2024-07-01"]
    assert store.open("enheter").count() == 4 and "extra" in store.open("enheter").columns
    assert rows(store.manifest(), "id", "record_count") == [("enheter-2024-01-01", 2), ("enheter-2024-07-01", 2)]
    assert store.latest("enheter").count() == 2 and store.latest("roller") is None
    assert rows(retention_plan(store.listing("enheter"), 1, None, None), "remove") == [(False,), (True,)]
    assert len(store.cleanup("enheter", keep_n=1)) == 1 and len(store.snapshots("enheter")) == 1

    pages = tmp_path / "pages"
    pages.mkdir()
    event = lambda i, org, kind, day, patches=(): json.dumps({"oppdateringsid": i, "organisasjonsnummer": org, "endringstype": kind, "dato": f"2025-06-0{day}T10:00:00.000Z", "endringer": json.dumps(list(patches))})
    (pages / "1.json").write_text("\n".join([event(1, "3", "Ny", 1, [{"op": "add", "path": "/navn", "value": "C"}]), event(2, "1", "Endring", 1, [{"op": "replace", "path": "/antallAnsatte", "value": 9}]), event(3, "2", "Sletting", 2)]))
    sync.bootstrap(store, "enheter", first)
    sync.sync(store, "enheter", str(pages), f"file://{tmp_path}/cp")
    assert rows(store.state("enheter")) == [("1", "A", 9), ("3", "C", None)]
    expected = [("1", "change", "employees", "1", "9"), ("2", "exit", None, None, None), ("3", "entry", None, None, None)]
    assert rows(store.changelog(), "org_nr", "change_type", "field", "value_from", "value_to") == expected
    # the same batch once more changes nothing
    sync.apply_batch(store, "enheter", updates.events(updates.read_pages(spark, str(pages))), 0)
    assert rows(store.changelog(), "org_nr", "change_type", "field", "value_from", "value_to") == expected
    assert store.cursor("enheter")["cursor"] == 3 and store.status()["changelog_partitions"] == 1


def test_annotations(spark):
    state = spark.createDataFrame([("1", 0, "FADR", "a", None), ("2", 0, "ZZZZ", "b", None)], schema.ANNOTATIONS)
    assert rows(changes.annotations(state, infotypes=dictionaries.dictionary(spark, "infotype")), "infotype_desc") == [("Business address presumed incorrect",), ("ZZZZ",)]
    patch = "org_nr string, update_id long, timestamp string, operation string, field string, new_value string"
    patches = spark.createDataFrame([("1", 5, "t", "replace", "paategninger", None), ("2", 6, "t", "add", "paategninger_-_infotype", "NAVN"), ("2", 6, "t", "add", "paategninger_-_tekst", "n")], patch)
    new, log = changes.apply_annotation_patches(state, patches)
    assert rows(new, "org_nr", "position", "infotype", "tekst") == [("2", 0, "ZZZZ", "b"), ("2", 1, "NAVN", "n")]
    assert rows(log, "org_nr", "change_type", "value_from") == [("1", "annotation_cleared", "1"), ("2", "annotation_added", None)]


def test_labels_and_concordances(spark):
    df = spark.createDataFrame([("1", "AS"), ("2", "ZZZZZ"), ("3", None)], "org_nr string, legal_form string")
    out = label.label(df, dictionaries.label_tables(spark), ("legal_form",))
    assert out.columns == ["org_nr", "legal_form_code", "legal_form"]
    assert rows(out, "org_nr", "legal_form") == [("1", "Private limited company"), ("2", "ZZZZZ"), ("3", None)]
    table = spark.createDataFrame([("A", "B"), ("A", "C"), ("D", "E")], "source_code string, target_code string")
    codes = spark.createDataFrame([("A",), ("D",), ("X",), (None,)], "nace_1 string")
    assert rows(label.harmonize_nace(codes, table)) == sorted([("A", "B", True), ("D", "E", False), ("X", "X", False), (None, None, False)], key=str)


def test_graph(spark):
    table = spark.createDataFrame([role(), role(org_nr="222"), role(org_nr="222", person_id="p2", last_name="Olsen"), role(person_id=None, entity_org_nr="333", entity_name="Rev AS", role_code="REVI")], schema.ROLES)
    entities = spark.createDataFrame([("111", "One", "enheter"), ("222", "Two", "enheter")], "org_nr string, name string, registry string")
    seeds = entities.where("org_nr = '111'").select("org_nr")
    nodes, edges = graph.network(seeds, entities, {"roles": table}, depth=2)
    assert rows(nodes, "node_id", "node_type") == [("o:111", "enheter"), ("o:222", "entity"), ("o:333", "role_holder_entity"), ("p:1951-07-16_aarrestad_jan_", "person")]
    assert rows(edges, "from", "to", "edge_type") == [("o:333", "o:111", "entity_role"), ("p:1951-07-16_aarrestad_jan_", "o:111", "role"), ("p:1951-07-16_aarrestad_jan_", "o:222", "role")]
    assert rows(graph.projection(graph.board_network(table, entities)[1])) == [("o:111", "o:222", 1)]


def test_pairs_are_counted_where_they_are_made(spark):
    """No shuffle carries a row for each pair: boards travel with those that follow them."""
    edges = [(f"p:{i % 7}", f"o:{i % 11}") for i in range(60)] * 2
    table = spark.createDataFrame(edges, "from string, to string")
    expected = {}
    for p in {p for p, _ in edges}:
        boards = sorted({o for q, o in edges if q == p})
        for i, a in enumerate(boards):
            for b in boards[i + 1 :]:
                expected[a, b] = expected.get((a, b), 0) + 1
    for tile in (2, 512):
        found = graph.projection(table, tile)
        assert {(r.org_a, r.org_b): r.shared for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "hashpartitioning(org_a" not in plan and not [x for x in plan.splitlines() if "Exchange" in x and x.count("other#") + x.count("org_b#")]


def test_pairs_have_tasks_of_their_own(spark):
    """A row makes many pairs, so they are counted in more tasks than rows are shuffled to."""
    table = spark.createDataFrame([("p:1", "o:1"), ("p:1", "o:2")], "from string, to string")
    plan = graph.projection(table)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "Exchange hashpartitioning(org#" in x and ", 32)" in x]


def test_boards_of_one_person(spark):
    """A person on very many boards: pairs in tiles as without them, and no key that holds more than two tiles."""
    rnd = random.Random(1)
    edges = {(f"p:{rnd.randrange(30)}", f"o:{rnd.randrange(60)}") for _ in range(200)} | {("p:x", f"o:{i}") for i in range(150)} | {("p:y", f"o:{i}") for i in range(0, 150, 2)}
    table = spark.createDataFrame([*edges, *list(edges)[:9], (None, "o:1"), ("p:1", None)], "from string, to string")
    held = {}
    for p, o in edges:
        held.setdefault(p, set()).add(o)
    expected = {}
    for boards in held.values():
        for a in boards:
            for b in boards:
                if a < b:
                    expected[a, b] = expected.get((a, b), 0) + 1
    for tile in (8, 512):
        assert {(r.org_a, r.org_b): r.shared for r in graph.projection(table, tile).collect()} == expected
    assert {(r["from"], r._tiles) for r in graph.heavy(table.distinct(), "from", 64).collect()} == {("p:x", 3), ("p:y", 2)}
    persons = [role(org_nr=str(i), person_id="common") for i in range(700)] + [role(org_nr="5", person_id="q"), role(org_nr="9000", person_id="q"), role(org_nr="9001", person_id="r")]
    table = spark.createDataFrame(persons, schema.ROLES)
    seeds, names = spark.createDataFrame([("5",)], "org_nr string"), spark.createDataFrame([("1", "One")], "org_nr string, name string")
    nodes, edges = graph.interlocks(seeds, table, seeds, names)
    assert nodes.count() == 700 and edges.count() == 700 and {r.node_id for r in nodes.collect()} == {f"o:{i}" for i in range(700) if i != 5} | {"o:9000"}


def merged(table, code, day, target):
    """A code's merger from ``day`` on, followed one by one."""
    steps, name, at = 0, None, day
    while steps < 50:
        further = sorted((d, t, n) for s, t, n, d in table if s == code and at <= d <= target)
        if not further:
            return code, name, False
        at, code, name = further[0]
        steps += 1
    return code, name, any(s == code and at <= d <= target for s, t, n, d in table)


def test_codes_merged_more_than_once(spark):
    rnd = random.Random(5)
    day = lambda y: datetime.date(y, 1, 1)
    table = [(rnd.choice("ABCDEFGH"), t, f"name {t}", day(2010 + rnd.randrange(10))) for t in (rnd.choice("BCDEFGHIJ") for _ in range(12))]
    table += [("x", "y", "Y", day(2015)), ("y", "x", "X", day(2015)), ("m", "n", "N", day(2012)), ("n", "m", "M", day(2014))]
    shape = "source_code string, target_code string, target_name string, valid_from date"
    merges = spark.createDataFrame([*table, (None, "A", "a", day(2011)), ("A", None, "a", day(2011)), ("A", "Z", "z", None)], shape)
    codes = [(c, d) for c in [*"ABCDEFGHIxymn", None, "unknown"] for d in (None, day(2013), day(2016))]
    df = spark.createDataFrame([(c, d, "k") for c, d in codes], "municipality_code string, used date, source_code string")
    for target in (day(2016), day(2030)):
        got = label.harmonize_merged(df, merges, target, as_of="used").collect()
        assert len(got) == len(codes)
        for r in got:
            code, name, cyclic = merged(table, r.municipality_code, r.used or datetime.date(1, 1, 1), target) if r.municipality_code else (None, None, False)
            assert r.municipality_code_cyclic == cyclic
            if not cyclic:
                assert (r.municipality_code_harmonized, r.municipality_code_target_name) == (code, name), r
    assert label.harmonize_merged(df, merges, day(2030)).where("municipality_code = 'm' AND municipality_code_harmonized = 'm'").count() == 3
    assert label.harmonize_merged(df, merges.limit(0), day(2030)).where("municipality_code_harmonized <=> municipality_code").count() == len(codes)


def test_lookup(spark):
    main = spark.createDataFrame([("923609016", "Main")], "org_nr string, name string")
    sub = spark.createDataFrame([("984851006", "Sub")], "org_nr string, name string")
    gone = spark.createDataFrame([("974760673", datetime.date(2020, 1, 1))], "org_nr string, deletion_date date")
    assert lookup.entity("984851006", main, sub).first().registry == "underenheter"
    assert lookup.entity("974760673", main, sub, gone).first().deleted
    with pytest.raises(ValueError):
        lookup.entity("123456789", main, sub)


def test_intervals(spark):
    """Quantiles against known ones, and the density's integral up to them by Simpson's rule."""
    cases = [(2.0, 2.0), (1.0, 1.0), (5.5, 0.5), (0.5, 5.5), (3.5, 97.5), (40.5, 60.5), (4000.5, 96000.5), (500000.5, 500000.5)]
    levels = (0.025, 0.5, 0.975)
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a double, b double").repartition(4)
    found = {r.i: r for r in df.select("i", *[drift.beta_quantile(p, F.col("a"), F.col("b")).alias(f"q{k}") for k, p in enumerate(levels)]).collect()}
    assert abs(found[0].q1 - 0.5) < 1e-9 and abs(found[1].q2 - 0.975) < 1e-9 and abs(found[2].q0 - 0.6206) < 2e-3
    for i, (a, b) in enumerate(cases):
        if min(a, b) < 1:
            continue
        log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        density = lambda x: math.exp(log_front + (a - 1) * math.log(x) + (b - 1) * math.log1p(-x)) if 0 < x < 1 else float(a == b == 1)
        for p, q in zip(levels, found[i][1:]):
            low = max(0.0, q - 12 * math.sqrt(a * b / (a + b + 1)) / (a + b))
            h = (q - low) / 20_000
            total = sum((1, 4, 2)[0 if k in (0, 20_000) else 1 + (k % 2 == 0)] * density(low + k * h) for k in range(20_001)) * h / 3
            assert abs(total - p) < 1e-6, (a, b, p)
    for x, y in ((2, 3), (3, 2)):
        for p, q in ((0, 2), (1, 1), (2, 0)):
            assert abs(found[x][1 + p] - (1 - found[y][1 + q])) < 1e-9
    rows_ = spark.createDataFrame([(0, 10), (10, 10), (0, 0), (None, 10)], "k long, n long").repartition(2)
    out = {(r.k, r.n): r for r in drift.with_interval(rows_).collect()}
    assert out[(0, 10)].theta_low < 1e-4 and out[(10, 10)].theta_high > 1 - 1e-4 and out[(None, 10)].theta_low is None
    assert abs(out[(0, 0)].theta_low + out[(0, 0)].theta_high - 1) < 1e-9


def test_drift(spark):
    before = spark.createDataFrame([("AS", "a", 9, 10), ("AS", "b", 1, 10)], "segment string, path string, k long, n long")
    now = spark.createDataFrame([("AS", "c", 3, 10)], "segment string, path string, k long, n long")
    assert rows(drift.drifted(before, now)) == [("new", "AS", "c"), ("removed", "AS", "a")]


def test_queries_match_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans(spark):
    from registra.queries import QUERIES

    for name in ("snapshot_diff", "replay_asof", "board_summary", "flows_with_exits", "role_diff", "feed_patches"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan, name


def test_snapshots_of_different_types_open_as_one(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.write_snapshot(spark.createDataFrame([("1", "5")], "org_nr string, employees string"), "enheter", "2024-01-31")
    store.write_snapshot(spark.createDataFrame([("1", 6, "x")], "org_nr string, employees int, own string"), "enheter", "2024-02-29")
    assert rows(store.open("enheter"), "snapshot_date", "employees", "own") == sorted([(datetime.date(2024, 1, 31), 5, None), (datetime.date(2024, 2, 29), 6, "x")], key=str)
    assert store.open("enheter").schema["employees"].dataType.simpleString() == "int"


def test_sync_routes_annotations(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    sync.bootstrap(store, "enheter", spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "org_nr string, name string"))
    sync.bootstrap(store, "paategninger", spark.createDataFrame([("1", 0, "NAVN", "t", None), ("2", 0, "FADR", "u", None), ("3", 0, "FADR", "w", None)], schema.ANNOTATIONS))
    patch = lambda op, field, v: (op, field, v)
    batch = spark.createDataFrame(
        [
            (5, "1", "Endring", datetime.datetime(2024, 1, 1), [patch("replace", "paategninger", None)]),
            (6, "2", "Endring", datetime.datetime(2024, 1, 1), [patch("add", "paategninger_-_infotype", "NAVN"), patch("add", "paategninger_-_tekst", "v")]),
            (7, "3", "Sletting", datetime.datetime(2024, 1, 2), []),
        ], schema.UPDATES,
    )
    sync.apply_batch(store, "enheter", batch, 0)
    assert rows(store.state("paategninger"), "org_nr", "position", "infotype") == [("2", 0, "FADR"), ("2", 1, "NAVN")]
    kinds = {r.change_type for r in store.changelog().collect()}
    assert {"annotation_cleared", "annotation_added", "exit"} <= kinds


def test_nested_roles_are_shuffled_once(spark):
    """Lines and orders meet, then an organisation's roles: groups and entities are made where these lie."""
    from registra.plans import files

    plan = files.nested_roles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("Exchange hashpartitioning(org_nr") == 1
