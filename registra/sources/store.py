"""Dated snapshots, their manifest, retention, state and the changelog, all as Parquet under one root."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import schema
from . import ingest
from .tables import Tables, View

#: The table of changes; states are named by their kind.
CHANGELOG = "changelog"


class Store:
    """A root folder in any file system that Spark reads (K9). Only listings and small JSON files pass the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = Tables(spark, f"{self.root}/state")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    # snapshots

    def snapshots(self, kind: str) -> list[tuple[datetime.date, int, str]]:
        """(date, size, path) by date (K8); folders without a date or without data are passed over."""
        out = []
        for name in self._names(f"{self.root}/{kind}"):
            try:
                date = datetime.date.fromisoformat(name.removeprefix("snapshot_date="))
            except ValueError:
                continue
            path = f"{self.root}/{kind}/{name}"
            if any(f.endswith(".parquet") for f in self._names(path)):
                fs, p = self._fs(path)
                out.append((date, fs.getContentSummary(p).getLength(), path))
        return out

    def listing(self, kind: str) -> DataFrame:
        return self.spark.createDataFrame(self.snapshots(kind), schema.SNAPSHOTS)

    def write_snapshot(self, df: DataFrame, kind: str, date: str, force: bool = False, **provenance) -> bool:
        """Write one partition and its manifest row (K1-K3, K6); nothing if it is there, unless forced."""
        path = f"{self.root}/{kind}/snapshot_date={date}"
        if self._exists(path) and not force:
            return False
        counted = Observation()
        df.observe(counted, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
        rows = counted.get["rows"]
        self.append_manifest(id=f"{kind}-{date}", type=kind, snapshot_date=date, record_count=rows, parquet_path=path, **provenance)
        return True

    def import_file(self, path: str, kind: str, date: str, format: str = "csv", force: bool = False) -> bool:
        """A bulk file as a snapshot (K2, K3): CSV or JSON of entities, JSON of roles; it is kept where it is."""
        if kind == "roller":
            rows = ingest.flatten_roles(ingest.read_json(self.spark, path, ingest.ROLE_INPUT, lines=format == "jsonl"))
        elif format == "csv":
            rows = ingest.tidy(ingest.read_csv(self.spark, path))
        else:
            rows = ingest.parse_entities(ingest.read_json(self.spark, path, lines=format == "jsonl"))
        return self.write_snapshot(rows, kind, date, force, format=format, raw_path=path)

    def open(self, kind: str) -> DataFrame:
        """All snapshots as one table with snapshot_date, columns merged, known ones of their type."""
        found = self.snapshots(kind)
        if not found:
            raise FileNotFoundError(f"no snapshots of {kind}")
        alike: dict[str, list[str]] = {}
        for _, _, path in found:
            alike.setdefault(self.spark.read.parquet(path).schema.simpleString(), []).append(path)
        out = None
        for paths in alike.values():
            part = _typed(self.spark.read.option("basePath", f"{self.root}/{kind}").parquet(*paths))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def latest(self, kind: str) -> DataFrame | None:
        """The newest snapshot, or None."""
        found = self.snapshots(kind)
        if not found:
            return None
        return _typed(self.spark.read.parquet(found[-1][2]).withColumn("snapshot_date", F.lit(found[-1][0])))

    def cleanup(
        self, kind: str, keep_n: int | None = None, max_age_days: int | None = None,
        today: datetime.date | None = None
    ) -> list[str]:
        """Delete what retention_plan() names (K7)."""
        rows = retention_plan(self.listing(kind), keep_n, max_age_days, today or datetime.date.today()).where("remove").collect()
        for r in rows:
            fs, p = self._fs(r.path)
            fs.delete(p, True)
        return [r.path for r in rows]

    # manifest

    def append_manifest(self, **entry) -> None:
        row = {f.name: entry.get(f.name) for f in schema.MANIFEST}
        row["download_timestamp"] = row["download_timestamp"] or datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
        self.spark.createDataFrame([tuple(row.values())], schema.MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")

    def manifest(self) -> DataFrame:
        """Provenance rows (S20); missing values are NULL."""
        if not self._names(f"{self.root}/manifest"):
            return schema.empty(self.spark, schema.MANIFEST)
        return self.spark.read.schema(schema.MANIFEST).json(f"{self.root}/manifest")

    # state and changelog: log-structured tables, whose commits hold for all of them

    def has_state(self, kind: str) -> bool:
        return self.tables.view().has(kind)

    def state(self, kind: str, view: View | None = None) -> DataFrame | None:
        """The current rows of a state table (S18), or those of an earlier view."""
        return (view or self.tables.view()).rows(kind)

    def cursor(self, kind: str, view: View | None = None) -> dict:
        """Where a feed stands (C10): the last batch that took effect and the last event in it."""
        view = view or self.tables.view()
        return {"version": view.changed(kind)} | (view.mark(kind) or {"batch_id": -1, "cursor": 0})

    def write_state(self, df: DataFrame, kind: str, batch_id: int = 0, cursor: int = 0) -> None:
        """A state's rows, all of them, and the feed's position, in one commit (K4)."""
        tx = self.tables.begin()
        tx.replace(kind, df)
        tx.mark(kind, batch_id=batch_id, cursor=cursor)
        tx.commit()

    def write_changelog(self, rows: DataFrame, sync_date: str, batch_id: int) -> None:
        """A day's changes (K5, C11); its batches have rising numbers, and one that the log holds is passed over."""
        tx = self.tables.begin()
        name = f"{CHANGELOG}/{sync_date}"
        if (tx.view.mark(name) or {"batch_id": -1})["batch_id"] >= batch_id:
            return
        tx.append(CHANGELOG, rows.withColumn("sync_date", F.lit(sync_date).cast("date")), by=("sync_date",))
        tx.mark(name, batch_id=batch_id)
        tx.commit()

    def changelog(self, view: View | None = None) -> DataFrame:
        """All changelog rows with sync_date (S19); filters on it prune folders."""
        rows = (view or self.tables.view()).rows(CHANGELOG)
        return schema.empty(self.spark, schema.CHANGELOG).withColumn("sync_date", F.lit(None).cast("date")) if rows is None else rows

    def _held(self) -> dict[str, tuple[int, int]]:
        """Table -> (days or 1, bytes)."""
        out = {}
        for table, entry in self.tables.view().content["tables"].items():
            paths = [self.tables.path(table, r) for r in entry["runs"]]
            days = {n for p in paths for n in self._names(p) if n.startswith("sync_date=")}
            out[table] = (len(days) if table == CHANGELOG else 1, sum(self._fs(p)[0].getContentSummary(self._fs(p)[1]).getLength() for p in paths))
        return out

    def _kinds(self) -> list[str]:
        return [n for n in self._names(self.root) if n not in ("state", "manifest")]

    def status_table(self) -> DataFrame:
        """(part, kind, entries, bytes, rows) of snapshots, states and the changelog (K10, K11); rows by manifest."""
        out = []
        counts = {(r.type, r.snapshot_date): r.record_count for r in self.manifest().collect()}
        for kind in self._kinds():
            found = self.snapshots(kind)
            out.append(("snapshots", kind, len(found), sum(f[1] for f in found), sum(counts.get((kind, str(f[0])), 0) for f in found)))
        held = self._held()
        out += [("state", kind, *x, None) for kind, x in held.items() if kind != CHANGELOG]
        out.append(("changelog", None, *held.get(CHANGELOG, (0, 0)), None))
        return self.spark.createDataFrame(out, "part string, kind string, entries int, bytes long, rows long")

    def status(self) -> dict:
        """What there is (K10, K11): snapshots, positions of states, days of the changelog."""
        held = self._held()
        return {
            "snapshots": {k: len(self.snapshots(k)) for k in self._kinds()},
            "state": {k: self.cursor(k) for k in held if k != CHANGELOG},
            "changelog_partitions": held.get(CHANGELOG, (0, 0))[0],
        }


def _typed(df: DataFrame) -> DataFrame:
    """Known columns in their type, whatever a file holds."""
    kinds = {c: k for c, k in schema.COLUMN_TYPES.items() if c in df.columns} | {"snapshot_date": "date"}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def retention_plan(listing: DataFrame, keep_n: int | None, max_age_days: int | None, today) -> DataFrame:
    """``listing`` with ``remove``: older than the limit, or beyond the newest ``keep_n``."""
    if keep_n is None and max_age_days is None:
        raise ValueError("give keep_n or max_age_days")
    beyond, old = F.lit(False), F.lit(False)
    if keep_n is not None:
        beyond = F.row_number().over(W.orderBy(F.desc("snapshot_date"))) > keep_n
    if max_age_days is not None:
        old = F.col("snapshot_date") < F.date_sub(F.lit(today).cast("date"), max_age_days)
    return listing.withColumn("remove", beyond | old)
