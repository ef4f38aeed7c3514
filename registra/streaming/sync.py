"""An event-sourced mirror of the register: micro-batches of change feeds applied to states, one commit a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import schema
from ..operators.changes import apply_annotation_patches
from ..operators.diff import role_changes
from ..operators.replay import change_rows, replay
from ..sources import paging
from ..sources import updates as feeds
from ..sources.store import CHANGELOG, Store
from ..sources.tables import Transaction

ROLES, NOTES = "roller", "paategninger"


def bootstrap(store: Store, kind: str, initial: DataFrame, cursor: int = 0) -> None:
    """The first state from a full extract, with the feed's position (C3); nothing if there is a state."""
    bootstrap_all(store, {kind: initial}, {kind: cursor})


def bootstrap_all(store: Store, initial: dict[str, DataFrame], cursors: dict[str, int] | None = None) -> None:
    """First states of the kinds that have none yet, in one commit."""
    tx = store.tables.begin()
    for kind in [k for k in initial if not tx.view.has(k)]:
        tx.replace(kind, initial[kind])
        tx.mark(kind, batch_id=-1, cursor=(cursors or {}).get(kind, 0))
    if tx.wholes:
        tx.commit()


def _logged(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn("sync_date", F.lit(day).cast("date"))


def _entities(tx: Transaction, kind: str, batch: DataFrame, phase_order: bool, notes: list[DataFrame]) -> DataFrame:
    """Puts what a batch makes of the entities it names; its changelog rows. Only these entities are read and written."""
    touched = batch.select("org_nr").distinct()
    base = tx.view.rows(kind, touched)
    tx.put(kind, replay(base, batch, phase_order=phase_order), touched)
    if tx.view.has(NOTES):
        patches = feeds.update_fields(batch).where(F.lower("field").rlike("^paategninger"))
        gone = batch.where(F.col("change_type").isin(*schema.DELETED)).select("org_nr").distinct()
        notes.append(patches.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True))
    return change_rows(base, batch, registry=kind, phase_order=phase_order)


def _annotations(tx: Transaction, notes: list[DataFrame]) -> DataFrame:
    """Puts the annotations that patches of all kinds of entities leave; a deletion takes an entity's away."""
    every = notes[0]
    for more in notes[1:]:
        every = every.unionByName(more)
    touched = every.select("org_nr").distinct()
    new, log = apply_annotation_patches(tx.view.rows(NOTES, touched), every.where("NOT _gone").drop("_gone"))
    tx.put(NOTES, new.join(every.where("_gone").select("org_nr"), "org_nr", "left_anti"), touched)
    return log


def _roles(tx: Transaction, full: DataFrame, affected: DataFrame, timestamp: str, held: list[DataFrame]) -> DataFrame:
    """Puts the affected organisations' roles; the changelog rows. What is read several times is ``held`` until the
    commit: the extract may be far more work to make than its rows are to keep."""
    affected = affected.select("org_nr").distinct().persist()
    held.append(affected)
    old, new = tx.view.rows(ROLES, affected), full.join(affected, "org_nr", "left_semi").persist()
    held.append(new)
    tx.put(ROLES, new, affected)
    return role_changes(old, new, timestamp)


def apply_feeds(
    store: Store, batches: dict[str, DataFrame], batch_id: int, phase_order: bool = False,
    roles: Callable[[DataFrame], DataFrame] | None = None
) -> bool:
    """One batch of several feeds (C2, C4-C9, C11): states, annotations, changelog and positions in a single commit.

    ``batches`` has events by kind; those of ``roller`` name organisations whose roles have changed, and ``roles`` tells
    their roles as they are now, all of them. Events count once by update_id; a kind whose state already holds the
    batch is passed over, and so is a batch without events. A batch that fails anywhere leaves nothing to be seen and
    can be applied again. Tells whether anything was committed.
    """
    tx = store.tables.begin()
    logs, notes, held = [], [], []
    try:
        for kind, batch in batches.items():
            if not tx.view.has(kind):
                raise ValueError(f"{kind} has no state yet: bootstrap it")
            if tx.view.mark(kind)["batch_id"] >= batch_id:
                continue
            batch = batch.dropDuplicates(["update_id"]).persist()
            held.append(batch)
            last = batch.agg(F.max("update_id").alias("id"), F.max("timestamp").cast("date").cast("string").alias("day"), F.date_format(F.max("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("at")).first()
            if last.id is None:
                continue
            log = _roles(tx, roles(batch.select("org_nr").distinct()), batch, last.at, held) if kind == ROLES else _entities(tx, kind, batch, phase_order, notes)
            logs.append((log, last.day))
            tx.mark(kind, batch_id=batch_id, cursor=last.id)
        if not logs:
            return False
        if notes:
            logs.append((_annotations(tx, notes), max(day for _, day in logs)))
            tx.mark(NOTES, **{k: max(m[k] for n, m in tx.marks.items() if n != NOTES) for k in ("batch_id", "cursor")})
        every = None
        for log, day in logs:
            rows = _logged(log, day)
            every = rows if every is None else every.unionByName(rows, allowMissingColumns=True)
        tx.append(CHANGELOG, every, by=("sync_date",))
        tx.commit()
    finally:
        for batch in held:
            batch.unpersist()
    for table in (*tx.puts, CHANGELOG):
        store.tables.compact(table)
    return True


def apply_batch(store: Store, kind: str, batch: DataFrame, batch_id: int, phase_order: bool = False) -> None:
    """One batch of one feed; see apply_feeds()."""
    apply_feeds(store, {kind: batch}, batch_id, phase_order)


def apply_roles(store: Store, full: DataFrame, timestamp: str, batch_id: int, affected: DataFrame | None = None) -> None:
    """A full extract of roles, or that of the ``affected`` organisations, against the state."""
    tx = store.tables.begin()
    if (tx.view.mark(ROLES) or {"batch_id": -1})["batch_id"] >= batch_id:
        return
    held: list[DataFrame] = []
    try:
        if affected is not None and tx.view.has(ROLES):
            rows = _roles(tx, full, affected, timestamp, held)
        else:
            held.append(full.persist())
            rows = role_changes(tx.view.rows(ROLES), full, timestamp)
            tx.replace(ROLES, full)
        tx.append(CHANGELOG, _logged(rows, timestamp[:10]), by=("sync_date",))
        tx.mark(ROLES, batch_id=batch_id, cursor=(tx.view.mark(ROLES) or {"cursor": 0})["cursor"])
        tx.commit()
    finally:
        for rows in held:
            rows.unpersist()


def sync_feeds(
    store: Store, pages: dict[str, str], checkpoint: str, initial: dict[str, DataFrame] | None = None,
    roles: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 5, phase_order: bool = False,
    paged: bool = False, max_pages: int | None = None
):
    """Read all new pages of all feeds once and apply them (C2, C3); returns the finished query.

    ``pages`` has a folder by kind; kinds without a state get the ``initial`` one first. The feeds are one stream, so a
    batch holds what is new in each and is one commit. The checkpoint is the cursor. With ``paged`` the folders are
    stored pages whose names tell their ids: the run is one poll of at most ``max_pages`` pages a feed, from where the
    state stands; see paging.read_events().
    """
    bootstrap_all(store, initial or {})
    stream = None
    for kind, path in pages.items():
        shape = feeds.ROLE_EVENT if kind == ROLES else feeds.EVENT
        if paged:
            raw = paging.read_events(store.spark, path, store.cursor(kind)["cursor"], max_pages, True, shape)
        else:
            raw = feeds.read_pages(store.spark, path, True, files_per_batch, shape)
        rows = (feeds.role_events(raw) if kind == ROLES else feeds.events(raw)).withColumn("_feed", F.lit(kind))
        stream = rows if stream is None else stream.unionByName(rows, allowMissingColumns=True)

    def apply(batch: DataFrame, n: int) -> None:
        apply_feeds(store, {k: batch.where(F.col("_feed") == k).drop("_feed") for k in pages}, n, phase_order, roles)

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def sync(store: Store, kind: str, pages: str, checkpoint: str, files_per_batch: int = 5, phase_order: bool = False):
    """Read all new pages of one feed once and apply them; see sync_feeds()."""
    return sync_feeds(store, {kind: pages}, checkpoint, files_per_batch=files_per_batch, phase_order=phase_order)


def daily_flows(feed: DataFrame, late: str = "2 days") -> DataFrame:
    """Entries and exits of a stream of events by day, with a watermark for late ones."""
    kind = F.col("change_type")
    return feed.withWatermark("timestamp", late).groupBy(F.window("timestamp", "1 day").alias("day")).agg(
        F.count_if(kind == "Ny").alias("entries"), F.count_if(kind.isin("Sletting", "Fjernet")).alias("exits")
    )
