"""Log-structured tables under one root, and commits that name the runs of all of them at once.

A table is a list of runs, oldest first: a run holds all rows that its keys have from then on, or that they have none.
A batch of k events so writes runs of about k rows, whatever the table holds; a reader takes each key's newest run.
Whole runs lie in buckets of their key, so reading a few keys opens a few buckets. Small runs are merged into larger
ones when enough of like size have come together.

A commit is one small file with the next number, put only if no other has that number: readers see a commit or they
don't, across all tables, and of two writers one is told. What a failed writer leaves is named by no commit.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stores that have no atomic rename, but put an object only if there is none.
OBJECT_STORES = ("s3a", "s3", "gs", "oss", "cosn", "wasb", "wasbs")
BUCKET_ROWS, MOST_BUCKETS, MERGED_RUNS = 1_000_000, 4096, 4


class Conflict(RuntimeError):
    """Another writer has committed a change to the same table or mark."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one of that name; tells whether it was written.

    Local files are linked and others renamed into place, both of which fail if the name is taken; object stores get
    a conditional create.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme = fs.getUri().getScheme()
    if fs.exists(target):
        return False

    def write(out) -> None:
        out.write(bytearray(text.encode()))
        out.close()

    if scheme in OBJECT_STORES:
        try:
            write(fs.createFile(target).overwrite(False).recursive().opt("fs.option.create.conditional.overwrite", True).build())
        except Py4JJavaError:
            if fs.exists(target):
                return False
            raise
        return True
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    write(fs.create(temporary, True))
    try:
        if scheme != "file":
            return fs.rename(temporary, target)
        try:
            os.link(temporary.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        fs.delete(temporary, False)


class Tables:
    """``keep`` commits stay readable; runs that only earlier ones name are deleted."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 10):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/{version:020d}.json"

    def _content(self, version: int) -> dict:
        fs, p = self._fs(self._commit_path(version))
        read = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(read)).decode())
        finally:
            read.close()

    def view(self, version: int | None = None) -> View:
        """All tables as of one commit, the last if none is named."""
        if version is None:
            version = max(self._versions(), default=0)
        return View(self, version, self._content(version) if version else {"tables": {}, "marks": {}})

    def begin(self) -> Transaction:
        return Transaction(self)

    def path(self, table: str, run: dict) -> str:
        return f"{self.root}/data/{table}/{run['id']}"

    def write_run(self, table: str, rows: DataFrame, key: str | None = None, whole: bool = False, by: Sequence[str] = ()) -> dict:
        """A run that no commit names yet. Whole ones are dealt into buckets, others are written as they come: the shuffle
        that made them has as many parts as their size asks."""
        run, held = {"id": uuid.uuid4().hex, "buckets": 0}, None
        if whole:
            # counted and then written: what they are made by may be far more work than they are
            if not (rows.storageLevel.useMemory or rows.storageLevel.useDisk):
                held = rows.persist()
            run["buckets"] = min(MOST_BUCKETS, rows.count() // BUCKET_ROWS + 1)
            # sorted as the folders ask, so that writing sorts no second time; a task gets few buckets, however many there are
            tasks = (run["buckets"],) if run["buckets"] > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else ()
            rows = rows.withColumn("_bucket", bucket(key, run["buckets"])).repartition(*tasks, "_bucket").sortWithinPartitions("_bucket", key)
            by = ("_bucket",)
        try:
            rows.write.partitionBy(*by).parquet(self.path(table, run))
        finally:
            if held is not None:
                held.unpersist()
        return run | {"schema": rows.schema.jsonValue(), "rows": self.read_run(table, run | {"schema": rows.schema.jsonValue()}).count()}

    def read_run(self, table: str, run: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(run["schema"])).parquet(self.path(table, run))

    def compact(self, table: str) -> bool:
        """Merge the newest runs of a table if enough of like size have come together; tells whether it did.

        Where the oldest run takes part the result is whole again and forgets keys without rows.
        """
        tx = self.begin()
        entry = tx.view.content["tables"].get(table)
        first = _mergeable([r["rows"] for r in entry["runs"]]) if entry else None
        if first is None:
            return False
        whole = first == 0 and entry["key"] is not None
        rows = tx.view.rows(table) if whole else tx.view.newest(table, first)
        merged = self.write_run(table, rows, entry["key"], whole, () if entry["key"] else entry["by"])
        tx.merges[table] = ([r["id"] for r in entry["runs"][first:]], merged)
        tx.commit()
        return True

    def expire(self) -> None:
        """Delete commits beyond the newest ``keep``, and the runs that only they name."""
        versions = self._versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if old:
            held = {self.path(t, r) for v in kept for t, e in self._content(v)["tables"].items() for r in e["runs"]}
            for v in old:
                for path in {self.path(t, r) for t, e in self._content(v)["tables"].items() for r in e["runs"]} - held:
                    self._delete(path)
                self._delete(self._commit_path(v))

    def sweep(self, older_than_seconds: float = 7 * 86400) -> list[str]:
        """Delete runs that no commit names and that are older than any writer still at work could have left them."""
        held = {self.path(t, r) for v in self._versions() for t, e in self._content(v)["tables"].items() for r in e["runs"]}
        fs, p = self._fs(f"{self.root}/data")
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        gone = []
        for table in fs.listStatus(p) if fs.exists(p) else []:
            for run in fs.listStatus(table.getPath()):
                path = f"{self.root}/data/{table.getPath().getName()}/{run.getPath().getName()}"
                if path not in held and run.getModificationTime() <= now - older_than_seconds * 1000:
                    self._delete(path)
                    gone.append(path)
        return gone

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _mergeable(sizes: list[int]) -> int | None:
    """The first of the newest runs that are to be merged: each at most twice as large as those after it together."""
    if not sizes:
        return None
    first, total = len(sizes) - 1, sizes[-1]
    while first > 0 and sizes[first - 1] <= 2 * total:
        first -= 1
        total += sizes[first]
    return first if len(sizes) - first >= MERGED_RUNS else None


class View:
    """All tables as one commit has them; later commits don't change what it reads."""

    def __init__(self, tables: Tables, version: int, content: dict):
        self.tables, self.version, self.content = tables, version, content

    def has(self, table: str) -> bool:
        return table in self.content["tables"]

    def mark(self, name: str) -> dict | None:
        return self.content["marks"].get(name)

    def changed(self, table: str) -> int | None:
        """The commit that last changed the rows of a table; merging runs doesn't."""
        return self.content["tables"][table]["changed"] if self.has(table) else None

    def _entry(self, table: str) -> tuple[dict, list[DataFrame]]:
        entry = self.content["tables"][table]
        return entry, [self.tables.read_run(table, r) for r in entry["runs"]]

    def newest(self, table: str, first: int, keys: DataFrame | None = None) -> DataFrame:
        """Rows of the runs from ``first`` on, each key's of its newest one, with ``_gone`` for keys without rows."""
        entry, runs = self._entry(table)
        key, out = entry["key"], None
        for seq, rows in enumerate(runs[first:]):
            rows = (rows if keys is None else rows.join(keys, key, "left_semi")).drop("_bucket")
            rows = rows.withColumn("_seq", F.lit(seq)) if key else rows
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        if key is None:
            return out
        if len(runs) - first > 1:
            out = out.withColumn("_last", F.max("_seq").over(W.partitionBy(key))).where("_seq = _last").drop("_last")
        return out.drop("_seq")

    def rows(self, table: str, keys: DataFrame | None = None) -> DataFrame | None:
        """The rows of a table, or those of ``keys``; None if there is no such table.

        Rows of the whole run stay where they are: they are only held against the keys of newer runs.
        """
        if not self.has(table):
            return None
        entry, runs = self._entry(table)
        key = entry["key"]
        if key is None:
            return self.newest(table, 0)
        base, whole = runs[0], entry["runs"][0]
        if keys is not None:
            keys = keys.select(key).distinct()
            if whole["buckets"] > 1:
                touched = [r[0] for r in keys.select(bucket(key, whole["buckets"])).distinct().collect()]
                base = base.where(F.col("_bucket").isin(touched))
            base = base.join(keys, key, "left_semi")
        base = base.drop("_bucket")
        if len(runs) == 1:
            return base
        newer = self.newest(table, 1, keys)
        return base.join(newer.select(key), key, "left_anti").unionByName(newer.where("NOT _gone").drop("_gone"), allowMissingColumns=True)


class Transaction:
    """Changes to several tables and marks that become visible together, or not at all.

    Everything is read as of the commit before it. Committing fails if another has meanwhile changed a table that this
    one puts or replaces, or a mark that it sets; changes elsewhere, additions to the same log, and merged runs don't
    disturb it.
    """

    def __init__(self, tables: Tables):
        self.tables, self.view = tables, tables.view()
        self.puts: dict[str, dict] = {}
        self.wholes: dict[str, dict] = {}
        self.appends: dict[str, dict] = {}
        self.marks: dict[str, dict] = {}
        self.merges: dict[str, tuple[list[str], dict]] = {}

    def replace(self, table: str, rows: DataFrame, key: str = "org_nr") -> None:
        """A table's rows, all of them."""
        self.wholes[table] = {"key": key, "by": [], "run": self.tables.write_run(table, rows, key, whole=True)}

    def put(self, table: str, rows: DataFrame, touched: DataFrame) -> None:
        """All rows that the ``touched`` keys have now; those without any lose what they had."""
        key = self.view.content["tables"][table]["key"]
        gone = touched.select(key).distinct().join(rows.select(key), key, "left_anti").withColumn("_gone", F.lit(True))
        run = self.tables.write_run(table, rows.withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True))
        if run["rows"]:
            self.puts[table] = run

    def append(self, table: str, rows: DataFrame, by: Sequence[str] = ()) -> None:
        """Further rows of a table without keys, in folders ``by`` columns."""
        run = self.tables.write_run(table, rows, by=by)
        if run["rows"]:
            self.appends[table] = {"key": None, "by": list(by), "run": run}

    def mark(self, name: str, **values) -> None:
        self.marks[name] = values

    def commit(self) -> int:
        """The number of the commit; raises Conflict."""
        while True:
            head = self.tables.view()
            self._check(head)
            version = head.version + 1
            text = json.dumps({"tables": self._tables(head, version), "marks": head.content["marks"] | self.marks})
            if put_if_absent(self.tables.spark, self.tables._commit_path(version), text):
                self.tables.expire()
                return version

    def _check(self, head: View) -> None:
        for table in (*self.puts, *self.wholes):
            if head.changed(table) != self.view.changed(table):
                raise Conflict(f"table {table} was changed by commit {head.changed(table)}")
        for name in self.marks:
            if head.mark(name) != self.view.mark(name):
                raise Conflict(f"mark {name} was set by another commit")
        for table, (ids, _) in self.merges.items():
            held = [r["id"] for r in head.content["tables"][table]["runs"]]
            if ids[0] not in held or held[held.index(ids[0]) : held.index(ids[0]) + len(ids)] != ids:
                raise Conflict(f"runs of {table} were merged by another")

    def _tables(self, head: View, version: int) -> dict:
        out = {t: e | {"runs": list(e["runs"])} for t, e in head.content["tables"].items()}
        for table, new in self.wholes.items():
            out[table] = {"key": new["key"], "by": new["by"], "changed": version, "runs": [new["run"]]}
        for table, run in self.puts.items():
            out[table] |= {"changed": version, "runs": [*out[table]["runs"], run]}
        for table, new in self.appends.items():
            entry = out.get(table, {"key": None, "by": new["by"], "runs": []})
            out[table] = entry | {"changed": version, "runs": [*entry["runs"], new["run"]]}
        for table, (ids, merged) in self.merges.items():
            runs = out[table]["runs"]
            at = [r["id"] for r in runs].index(ids[0])
            out[table]["runs"] = [*runs[:at], merged, *runs[at + len(ids) :]]
        return out
