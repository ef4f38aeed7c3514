"""A change feed in stored pages as a streaming source, whose offsets are event ids.

A page is a file of JSON lines named by its first and last event id, and holds all events between them. The driver
lists names only; the pages that a batch needs are read by tasks, and their lines are parsed in the JVM. A poll takes
at most so many pages from where the last one ended, which may lie within a page; a batch is one poll, or several, so
that catching up with a long feed doesn't cost a batch for every few pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .updates import EVENT

#: A poll from the beginning of a feed takes so many pages, unless told otherwise, and not the whole history.
FIRST_PAGES = 5
PAGE_SIZE = 10_000
#: A batch is read by so many tasks at most, each of them reading neighbouring pages.
MOST_TASKS = 64
_NAME = re.compile(r"(\d{1,20})-(\d{1,20})\.jsonl")


@dataclass
class PagePart(InputPartition):
    """The events of a page with ids above ``after`` and up to ``upto``."""

    path: str
    after: int
    upto: int


@dataclass
class PageParts(InputPartition):
    """Parts that one task reads, in order."""

    parts: Sequence[PagePart]


def dealt(parts: Sequence[PagePart], tasks: int = MOST_TASKS) -> list[PageParts]:
    """Parts by task: one each, or more where there are more than ``tasks``."""
    size = max(1, -(-len(parts) // tasks))
    return [PageParts(parts[i : i + size]) for i in range(0, len(parts), size)]


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def stored_pages(uri: str) -> list[tuple[int, int, str]]:
    """(first id, last id, path) of a folder's pages, in order; other files are passed over."""
    from pyarrow import fs

    system, path = _file_system(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    named = ((_NAME.fullmatch(f.base_name), f.path) for f in found if f.type == fs.FileType.File)
    return sorted((int(m[1]), int(m[2]), p) for m, p in named if m)


def parts_between(pages: Sequence[tuple[int, int, str]], start: int, end: int) -> list[PagePart]:
    """What is to be read for ids above ``start`` up to ``end``: pages that overlap give each id once."""
    out, at = [], start
    for _, last, path in pages:
        upto = min(last, end)
        if upto > at:
            out.append(PagePart(path, at, upto))
            at = upto
    return out


def poll_end(pages: Sequence[tuple[int, int, str]], start: int, max_pages: int | None, polls: int = 1) -> int:
    """The last id of a poll from ``start``: of the ``max_pages``-th page that has something new, or of the last one.
    Without a number, a poll from 0 takes FIRST_PAGES pages, any other all there are. Of several ``polls``, each begins
    where the one before it ended."""
    if max_pages is None:
        limit = FIRST_PAGES if start == 0 and polls == 1 else None
    else:
        limit = max_pages * polls
    parts = parts_between(pages, start, max((last for _, last, _ in pages), default=start))
    return parts[:limit][-1].upto if parts else start


class EventPages(DataSource):
    """``path`` (a folder as pyarrow's file systems name it), ``cursor`` (0: the beginning), ``maxPages`` a poll, ``polls`` a batch of a stream."""

    @classmethod
    def name(cls) -> str:
        return "event_pages"

    def schema(self) -> str:
        return "after long, upto long, value string"

    def _number(self, key: str) -> int | None:
        return int(self.options[key]) if key in self.options else None

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Poll(self.options["path"], self._number("cursor") or 0, self._number("maxPages"))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Stream(self.options["path"], self._number("cursor") or 0, self._number("maxPages"), self._number("polls") or 1)


class _Pages:
    def __init__(self, uri: str, cursor: int, max_pages: int | None, polls: int = 1):
        self.uri, self.cursor, self.max_pages, self.polls = uri, cursor, max_pages, polls

    def read(self, partition: PageParts) -> Iterator:
        system, _ = _file_system(self.uri)
        for part in partition.parts:
            yield from self._lines(system, part)

    def _lines(self, system, part: PagePart) -> Iterator:
        import pyarrow as pa

        with system.open_input_stream(part.path) as stream:
            rest, ended = b"", False
            while not ended:
                block = stream.read(1 << 22)
                ended = not block
                *lines, rest = (rest + block).split(b"\n")
                lines = [x for x in (lines + [rest] if ended else lines) if x.strip()]
                if lines:
                    n = len(lines)
                    yield pa.record_batch([pa.array([part.after] * n), pa.array([part.upto] * n), pa.array(lines).cast(pa.string())], names=["after", "upto", "value"])


class _Poll(_Pages, DataSourceReader):
    def partitions(self) -> Sequence[PageParts]:
        pages = stored_pages(self.uri)
        return dealt(parts_between(pages, self.cursor, poll_end(pages, self.cursor, self.max_pages))) or [PageParts([])]


class _Stream(_Pages, DataSourceStreamReader):
    """Offsets are the last event id of a batch; a restart goes on from the checkpoint's, not from the cursor."""

    at: int | None = None

    def initialOffset(self) -> dict:
        return {"id": self.cursor}

    def latestOffset(self) -> dict:
        start = self.cursor if self.at is None else self.at
        self.at = poll_end(stored_pages(self.uri), start, self.max_pages, self.polls)
        return {"id": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[PageParts]:
        # after a restart, Spark plans the last batch of its log before it asks for more
        self.at = max(self.at or 0, end["id"])
        return dealt(parts_between(stored_pages(self.uri), start["id"], end["id"]))

    def commit(self, end: dict) -> None:
        self.at = max(self.at or 0, end["id"])


def read_events(
    spark: SparkSession, path: str, cursor: int = 0, max_pages: int | None = None, streaming: bool = False,
    schema: T.StructType = EVENT, polls: int = 1
) -> DataFrame:
    """Feed rows past ``cursor``: one poll (S12), or a stream of polls, ``polls`` a batch.

    Each event comes once, whatever pages overlap. ``max_pages`` bounds a poll; without it, one from cursor 0 takes
    FIRST_PAGES pages, so that a first poll doesn't replay the whole history. A stream's checkpoint keeps the id that
    was reached; ``cursor`` only says where a new one begins. The schema's first column is the event's id.
    """
    spark.dataSource.register(EventPages)
    source = (spark.readStream if streaming else spark.read).format("event_pages").option("path", path).option("cursor", cursor).option("polls", polls)
    rows = (source if max_pages is None else source.option("maxPages", max_pages)).load()
    rows = rows.select("after", "upto", F.from_json("value", schema).alias("_e"))
    event = F.col(f"_e.{schema.fields[0].name}")
    return rows.where((event > F.col("after")) & (event <= F.col("upto"))).select("_e.*")


def write_pages(events: DataFrame, path: str, size: int = PAGE_SIZE) -> None:
    """Feed rows as stored pages, each of the ids of a stretch of ``size``; a page is seen whole or not at all.

    The first column is the event's id. Writing the same events again writes the same pages.
    """
    key = events.columns[0]

    def write(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        group = group.sort_by(key)
        ids = group.column(key)
        system, folder = _file_system(path)
        system.create_dir(folder, recursive=True)
        target = f"{folder}/{ids[0].as_py():020d}-{ids[-1].as_py():020d}.jsonl"
        with system.open_output_stream(target + ".tmp") as out:
            out.write(("\n".join(group.column("value").to_pylist()) + "\n").encode())
        system.move(target + ".tmp", target)
        return pa.table({"n": pa.array([len(ids)], pa.int64()), "last": pc.cast(ids.slice(len(ids) - 1), pa.int64()).combine_chunks()})

    rows = events.where(F.col(key).isNotNull()).select(key, F.to_json(F.struct(*events.columns)).alias("value"), F.floor(F.col(key) / size).alias("_page"))
    rows.groupBy("_page").applyInArrow(lambda t: write(t.drop_columns(["_page"])), "n long, last long").write.format("noop").mode("overwrite").save()
