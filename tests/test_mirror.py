"""Log-structured tables, the mirror, bucketed snapshots: what is written, what readers see, what failures leave."""

import datetime
import json
import random

import pytest

from registra.functions import schema
from registra.operators import diff
from registra.sources import buckets, paging, updates
from registra.sources import tables as T
from registra.sources.store import CHANGELOG, Store
from registra.sources.tables import Conflict, Tables
from registra.streaming import sync

ROW = "org_nr string, v int"


def held(df):
    return sorted(tuple(r) for r in df.select("org_nr", "v").collect())


def frame(spark, rows):
    return spark.createDataFrame(list(rows), ROW)


def put(tables, rows, keys):
    tx = tables.begin()
    tx.put("t", frame(tables.spark, rows), frame(tables.spark, [(k, 0) for k in keys]))
    return tx.commit()


def test_rows_of_random_changes(spark, tmp_path, monkeypatch):
    """Several rows a key, keys that go and come back, runs merged on the way: as a dictionary has it."""
    monkeypatch.setattr(T, "BUCKET_ROWS", 40)
    rnd, tables = random.Random(3), Tables(spark, f"file://{tmp_path}", keep=3)
    model = {str(k): [k, k + 1] for k in range(60)}
    tx = tables.begin()
    tx.replace("t", frame(spark, [(k, v) for k, vs in model.items() for v in vs]))
    tx.commit()
    assert tables.view().content["tables"]["t"]["runs"][0]["buckets"] == 4
    merged = 0
    for _ in range(7):
        keys = [str(rnd.randrange(80)) for _ in range(3)]
        change = {k: [rnd.randrange(1000) for _ in range(rnd.choice([0, 1, 2]))] for k in keys}
        model |= change
        put(tables, [(k, v) for k, vs in change.items() for v in vs], change)
        # what was written is what changed, not what is held
        assert tables.view().content["tables"]["t"]["runs"][-1]["rows"] <= 2 * len(change)
        merged += tables.compact("t")
    expected = sorted((k, v) for k, vs in model.items() for v in vs)
    assert held(tables.view().rows("t")) == expected and merged
    some = frame(spark, [(str(k), 0) for k in (1, 5, 79, 200)])
    assert held(tables.view().rows("t", some)) == [x for x in expected if x[0] in ("1", "5", "79")]
    assert len(tables._versions()) == 3 and tables.sweep(0) == []


def test_runs_of_like_size_are_merged():
    assert T._mergeable([10**6, 5, 5, 5]) is None and T._mergeable([10**6, 5, 5, 5, 5]) == 1
    assert T._mergeable([10**6, 400, 5, 5, 5, 5]) == 2 and T._mergeable([10, 5, 5, 5]) == 0 and T._mergeable([]) is None
    sizes, written = [10**6], 0
    for _ in range(1000):
        sizes.append(10)
        if (first := T._mergeable(sizes)) is not None:
            written += sum(sizes[first:])
            sizes[first:] = [sum(sizes[first:])]
    assert len(sizes) < 20 and written < 10 * 10_000


def test_two_writers(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}")
    tx = tables.begin()
    for t in "tu":
        tx.replace(t, frame(spark, [("1", 1), ("2", 2)]))
    tx.commit()
    a, b, c = tables.begin(), tables.begin(), tables.begin()
    change = lambda tx, t, v: tx.put(t, frame(spark, [("1", v)]), frame(spark, [("1", 0)]))
    change(a, "t", 10)
    change(b, "t", 20)
    change(c, "u", 30)
    for tx, v in ((a, 1), (c, 2)):
        tx.append("log", frame(spark, [("x", v)]))
    assert (a.commit(), c.commit()) == (2, 3)
    with pytest.raises(Conflict):
        b.commit()
    now = tables.view()
    assert held(now.rows("t")) == [("1", 10), ("2", 2)] and held(now.rows("u")) == [("1", 30), ("2", 2)] and held(now.rows("log")) == [("x", 1), ("x", 2)]
    assert held(tables.view(1).rows("t")) == [("1", 1), ("2", 2)]
    # the run that the refused writer left
    assert len(tables.sweep(0)) == 1 and held(tables.view().rows("t")) == [("1", 10), ("2", 2)]
    d, e = tables.begin(), tables.begin()
    d.mark("m", n=1)
    e.mark("m", n=2)
    d.commit()
    with pytest.raises(Conflict):
        e.commit()
    assert not T.put_if_absent(spark, tables._commit_path(1), "{}") and tables.view().mark("m") == {"n": 1}


def batch_of(spark, first_id):
    at = datetime.datetime(2024, 1, 1)
    return {
        "enheter": spark.createDataFrame([
            (first_id, "1", "Endring", at, [("replace", "navn", "Z"), ("replace", "paategninger", None)]), (first_id + 1, "2", "Sletting", at, []), (first_id + 2, "9", "Ny", at, [("add", "navn", "N")]),
        ], schema.UPDATES),
        "underenheter": spark.createDataFrame([(first_id, "7", "Endring", at, [("replace", "navn", "Y")])], schema.UPDATES),
        "roller": spark.createDataFrame([(first_id, "1", "oppdatert", at, None)], schema.UPDATES),
    }


def role(org, code):
    return tuple({"org_nr": org, "role_group_code": "STYR", "role_code": code, "person_id": "p", "ordering": 1}.get(f.name) for f in schema.ROLES)


def a_store(spark, path):
    store, name = Store(spark, f"file://{path}"), "org_nr string, name string"
    notes = [("1", 0, "NAVN", "t", None), ("2", 0, "FADR", "u", None), ("3", 0, "FADR", "w", None)]
    sync.bootstrap_all(store, {
        "enheter": spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], name), "underenheter": spark.createDataFrame([("7", "S"), ("8", "T")], name),
        "roller": spark.createDataFrame([role("1", "LEDE"), role("3", "LEDE")], schema.ROLES), "paategninger": spark.createDataFrame(notes, schema.ANNOTATIONS),
    })
    return store


def everything(store):
    view = store.tables.view()
    states = {k: sorted(map(str, view.rows(k).collect())) for k in ("enheter", "underenheter", "roller", "paategninger")}
    return states, sorted(map(str, store.changelog(view).collect())), {k: store.cursor(k, view)["batch_id"] for k in states}


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """A failure at any of the writes leaves what was; the batch applied again makes what it would have made."""
    store = a_store(spark, tmp_path / "a")
    roles = lambda affected: spark.createDataFrame([role("1", "MEDL")], schema.ROLES)
    before, real, put_real = everything(store), Tables.write_run, T.put_if_absent
    writes = 0

    def counted(self, *args, **kwargs):
        nonlocal writes
        writes += 1
        if writes == stop:
            raise OSError("lost")
        return real(self, *args, **kwargs)

    monkeypatch.setattr(Tables, "write_run", counted)
    for stop in (1, 3, 5):
        writes = 0
        with pytest.raises(OSError):
            sync.apply_feeds(store, batch_of(spark, 10), 0, roles=roles)
        assert everything(store) == before
    monkeypatch.setattr(Tables, "write_run", real)
    monkeypatch.setattr(T, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sync.apply_feeds(store, batch_of(spark, 10), 0, roles=roles)
    assert everything(store) == before
    monkeypatch.setattr(T, "put_if_absent", put_real)
    assert sync.apply_feeds(store, batch_of(spark, 10), 0, roles=roles)
    after = everything(store)
    # done: the same batch is passed over, as after a failure between the commit and the checkpoint
    assert not sync.apply_feeds(store, batch_of(spark, 10), 0, roles=roles) and everything(store) == after
    assert sorted((r.org_nr, r.name) for r in store.state("enheter").collect()) == [("1", "Z"), ("3", "C"), ("9", "N")]
    assert [r.org_nr for r in store.state("paategninger").collect()] == ["3"] and [(r.org_nr, r.role_code) for r in store.state("roller").orderBy("org_nr").collect()] == [("1", "MEDL"), ("3", "LEDE")]
    kinds = {(r.registry, r.change_type) for r in store.changelog().collect()}
    assert {("enheter", "change"), ("enheter", "exit"), ("enheter", "entry"), ("underenheter", "change"), ("roller", "entry"), ("roller", "exit"), ("paategninger", "annotation_cleared")} <= kinds
    assert all(n <= 3 for t in ("enheter", "roller", "paategninger") for n in [store.tables.view().content["tables"][t]["runs"][-1]["rows"]])
    # the changelog and the states are of one commit, whichever is read
    old = store.tables.view(store.tables.view().version - 1)
    assert not old.has(CHANGELOG) and old.rows("enheter").count() == 3


def test_feeds_in_one_stream(spark, tmp_path):
    event = lambda i, org, kind, day, name=None: json.dumps({"oppdateringsid": i, "organisasjonsnummer": org, "endringstype": kind, "dato": f"2025-06-0{day}T10:00:00.000Z", "endringer": json.dumps([{"op": "replace", "path": "/navn", "value": name}] if name else [])})
    pages = {k: tmp_path / k for k in ("enheter", "underenheter", "roller")}
    for p in pages.values():
        p.mkdir()
    (pages["enheter"] / "1.json").write_text(event(1, "1", "Endring", 1, "B") + "\n" + event(2, "2", "Ny", 2, "N"))
    (pages["underenheter"] / "1.json").write_text(event(1, "7", "Sletting", 1))
    (pages["roller"] / "1.json").write_text(json.dumps({"id": 5, "type": "x.rolle.oppdatert", "time": "2025-06-03T00:00:00Z", "data": {"organisasjonsnummer": "1"}}))
    store, name = Store(spark, f"file://{tmp_path}/store"), "org_nr string, name string"
    initial = {"enheter": spark.createDataFrame([("1", "A")], name), "underenheter": spark.createDataFrame([("7", "S")], name), "roller": spark.createDataFrame([role("1", "LEDE")], schema.ROLES)}
    asked = []

    def roles(affected):
        asked.append(sorted(r.org_nr for r in affected.collect()))
        return spark.createDataFrame([role("1", "MEDL"), role("4", "LEDE")], schema.ROLES)

    run = lambda: sync.sync_feeds(store, {k: f"file://{p}" for k, p in pages.items()}, f"file://{tmp_path}/cp", initial, roles)
    run()
    version = store.tables.view().version
    assert version == 2 and asked == [["1"]]
    assert sorted(tuple(r) for r in store.state("enheter").collect()) == [("1", "B"), ("2", "N")] and store.state("underenheter").count() == 0
    assert [(r.org_nr, r.role_code) for r in store.state("roller").collect()] == [("1", "MEDL")]
    run()
    assert store.tables.view().version == version
    (pages["enheter"] / "2.json").write_text(event(3, "2", "Sletting", 4))
    run()
    assert store.tables.view().version == version + 1 and store.state("enheter").count() == 1 and store.cursor("enheter")["cursor"] == 3
    assert store.status()["changelog_partitions"] == 4


def feed_rows(spark, ids):
    return spark.createDataFrame([(i, str(i % 7), "Ny", "2024-01-01T00:00:00", "[]") for i in ids], updates.EVENT)


def ids_of(df):
    return sorted(r[0] for r in df.select("oppdateringsid").collect())


def test_polls_of_stored_pages(spark, tmp_path):
    """Pages that overlap give each event once; polls begin and go on within pages; a failed batch comes again."""
    path = f"file://{tmp_path}/pages"
    ids = [i for i in range(1, 700) if i % 3]
    paging.write_pages(feed_rows(spark, ids), path, 100)
    (tmp_path / "pages" / "notes.txt").write_text("no page")
    (tmp_path / "pages" / "x.jsonl.tmp").write_text("{")
    read = lambda **k: ids_of(paging.read_events(spark, path, **k))
    assert read() == [i for i in ids if i <= 499] and read(max_pages=100) == ids
    assert read(cursor=250) == [i for i in ids if i > 250] and read(cursor=250, max_pages=1) == [i for i in ids if 250 < i <= 299] and read(cursor=700) == []
    assert ids_of(paging.read_events(spark, f"file://{tmp_path}/none")) == []
    got, broken = [], [True]

    def take(batch, n):
        found = ids_of(batch)
        if n == 1 and broken:
            raise OSError(broken.pop())
        got.append((n, found))

    def run(max_pages, cursor):
        rows = paging.read_events(spark, path, cursor, max_pages, streaming=True)
        rows.writeStream.foreachBatch(take).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    run(2, 150)
    with pytest.raises(Exception, match="True"):
        run(1, 150)
    # another limit and another cursor: the batch that failed keeps its bounds, the next goes on from there
    run(3, 0)
    # a later page that overlaps what was read
    paging.write_pages(feed_rows(spark, range(640, 720)), path, 10_000)
    for _ in range(3):
        run(None, 0)
    assert got[0] == (0, [i for i in ids if 150 < i <= 299]) and got[1] == (1, [i for i in ids if 299 < i <= 398])
    assert [i for _, found in got for i in found] == [i for i in ids if 150 < i] + list(range(699, 720))


def test_extracts_are_read_once(spark, tmp_path):
    """An extract of roles is made once for its state, and once for a change of it, whatever is told by it."""
    store, seen = Store(spark, f"file://{tmp_path}/store"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def extract(code):
        rows = spark.createDataFrame([(str(i), "STYR", code, f"p{i}") for i in range(10)], "org_nr string, role_group_code string, role_code string, person_id string")
        return diff.backfill_roles(rows.mapInArrow(counted, rows.schema))

    sync.bootstrap(store, "roller", extract("LEDE"))
    assert seen.value == 10
    affected = spark.createDataFrame([("1",), ("2",)], "org_nr string")
    sync.apply_roles(store, extract("MEDL"), "2024-01-01T00:00:00", 1, affected)
    assert seen.value == 20
    assert sorted((r.org_nr, r.role_code) for r in store.state("roller").collect()) == [(str(i), "MEDL" if i in (1, 2) else "LEDE") for i in range(10)]
    sync.apply_roles(store, extract("VARA"), "2024-01-02T00:00:00", 2)
    assert seen.value == 30 and {r.role_code for r in store.state("roller").collect()} == {"VARA"}


def test_several_polls_a_batch(spark, tmp_path):
    """A batch of several polls ends where so many polls would, and neighbouring pages share tasks."""
    path, got = f"file://{tmp_path}/pages", []
    paging.write_pages(feed_rows(spark, range(1, 1001)), path, 10)

    def run(max_pages, cursor, polls):
        rows = paging.read_events(spark, path, cursor, max_pages, streaming=True, polls=polls)
        write = rows.writeStream.foreachBatch(lambda batch, n: got.append((ids_of(batch), batch.rdd.getNumPartitions())))
        write.option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    for polls in (3, 1, 100, 100):
        run(2, 15, polls)
    assert [(x[0], x[-1]) for x, _ in got] == [(16, 69), (70, 89), (90, 1000)] and [i for x, _ in got for i in x] == list(range(16, 1001))
    assert [n for _, n in got] == [6, 2, 46]
    pages = [(10 * i, 10 * i + 9, "") for i in range(10)]
    assert [paging.poll_end(pages, 0, None, polls) for polls in (1, 2)] == [49, 99] and paging.poll_end(pages, 49, None) == 99


def test_sync_of_stored_pages(spark, tmp_path):
    store, path = Store(spark, f"file://{tmp_path}/store"), f"file://{tmp_path}/pages"
    sync.bootstrap(store, "enheter", spark.createDataFrame([("1", "A")], "org_nr string, name string"), cursor=4)
    paging.write_pages(feed_rows(spark, range(1, 10)), path, 3)
    for reached in (5, 8, 9, 9):
        sync.sync_feeds(store, {"enheter": path}, f"file://{tmp_path}/cp", paged=True, max_pages=1)
        assert store.cursor("enheter")["cursor"] == reached
    assert sorted(r.org_nr for r in store.state("enheter").collect()) == ["0", "1", "2", "5", "6"]


def test_bucketed_snapshots_meet_without_a_shuffle(spark, tmp_path):
    rnd, kind = random.Random(9), "org_nr string, name string, employees int"
    old = {str(i): (rnd.choice(["a", None]), rnd.choice([1, None])) for i in range(400)}
    new = dict(old)
    del new["7"]
    new |= {"9": ("b", 1), "401": (None, None), "12": old["12"][::-1] if old["12"] == (None, None) else ("c", None)}
    frames = [spark.createDataFrame([(k, *v) for k, v in d.items()], kind) for d in (old, new)]
    paths = [f"file://{tmp_path}/{n}" for n in ("old", "new")]
    for df, path in zip(frames, paths):
        buckets.write_bucketed(df, path, parts=16, buckets=4)
    touched = {r[0] for r in spark.createDataFrame([("7",), ("9",), ("401",), ("12",)], "org_nr string").select(buckets.bucket("org_nr", 16)).collect()}
    assert set(buckets.differing_parts(spark, *paths)) == touched and buckets.differing_parts(spark, paths[0], paths[0]) == []
    expected = sorted(map(str, diff.snapshot_events(*frames, "2024-01-01").collect()))
    spark.sql(f"DROP TABLE {buckets._table_name(paths[0] + '/data')}")
    for _ in range(2):
        met = diff.snapshot_events(*buckets.changed_rows(spark, *paths), "2024-01-01")
        plan = met._jdf.queryExecution().executedPlan().toString()
        # small tables are broadcast in one of the two joins
        assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")
        assert sorted(map(str, met.collect())) == expected and len(expected) >= 4
        # from another session's folders
        spark.sql(f"DROP TABLE {buckets._table_name(paths[1] + '/data')}")
    # NULLs are told from their neighbours
    swapped = [spark.createDataFrame([("1", *v)], "org_nr string, a string, b string") for v in (("x", None), (None, "x"))]
    for df, path in zip(swapped, ("s", "t")):
        buckets.write_bucketed(df, f"file://{tmp_path}/{path}", parts=2, buckets=2)
    assert len(buckets.differing_parts(spark, f"file://{tmp_path}/s", f"file://{tmp_path}/t")) == 1


def test_roles_meet_where_their_first_rows_lie(spark):
    """Each extract of roles is shuffled once by its keys, whether for the first rows or for the join."""
    old, new = (spark.createDataFrame([], schema.ROLES) for _ in range(2))
    plan = diff.role_changes(old, new, "2024-01-01T00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(role_key") == 2


def test_runs_are_written_as_they_come(spark, tmp_path, monkeypatch):
    """A batch's run takes no shuffle of its own, and a whole run's rows are sorted once, by bucket and key."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **kw: (plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()), write(self, *args, **kw))[1])
    monkeypatch.setattr(T, "BUCKET_ROWS", 10)
    store = Tables(spark, f"file://{tmp_path}/runs")
    rows = spark.range(100).selectExpr("cast(id AS string) AS org_nr", "id AS v")
    store.write_run("t", rows)
    run = store.write_run("t", rows, "org_nr", whole=True)
    assert "Rebalance" not in plans[0] and "Repartition" not in plans[0]
    assert run["buckets"] == 11 and "RepartitionByExpression [_bucket#" in plans[1] and ", 11" in plans[1] and plans[1].splitlines()[0].startswith("Sort [_bucket")
    assert sorted(r.v for r in store.read_run("t", run).collect()) == list(range(100))


def test_pages_of_feeds_are_compressed(spark, monkeypatch):
    from pathlib import Path

    from registra.plans import files

    class Stop(Exception):
        pass

    seen = {}

    def stop(store, pages, *args, **kw):
        seen.update(pages)
        raise Stop

    monkeypatch.setattr(files.sync, "sync_feeds", stop)
    with pytest.raises(Stop):
        files.mirror_feeds(spark, "/root/testdata/sf0.001")
    for kind in ("enheter", "underenheter"):
        names = [p.name for p in Path(seen[kind].removeprefix("file://")).iterdir()]
        assert any(n.endswith(".json.gz") for n in names) and not any(n.endswith(".json") for n in names)
