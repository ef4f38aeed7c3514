"""Large files with quoted line breaks, and large JSON arrays, read by many tasks.

Files are cut into ranges of bytes. A first pass counts in each range the quotes, and for JSON the brackets that lie
outside strings if the range begins outside or inside one; running sums over a file's ranges then tell how each
begins. With that a second pass finds the records that start in a range, and reads on to the last one's end. Both
passes are tasks of one range each, or of neighbouring ones where these are small; only names and sizes of files pass
the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
_QUOTE, _BACKSLASH, _NEWLINE = b'"'[0], b"\\"[0], b"\n"[0]
_BEYOND = 1 << 20
#: Small ranges share tasks where there are more of them than this, and than two for each core.
TASKS = 64


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def files_of(uri: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of a folder's files whose names begin neither with a point nor an underscore."""
    from pyarrow import fs

    system, path = _system(uri)
    info = system.get_file_info(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.size and f.base_name[0] not in "._")


def _quotes(data, before: int):
    """Marks quotes that open or close a JSON string: those after an odd run of backslashes don't, ``before`` of which
    precede the data."""
    import numpy as np

    marks = data == _QUOTE
    if marks.any():
        place = np.arange(len(data))
        last = np.maximum.accumulate(np.where(data != _BACKSLASH, place, -1))
        run = np.empty(len(data), np.int64)
        run[:1] = before
        run[1:] = place[:-1] - last[:-1] + np.where(last[:-1] < 0, before, 0)
        marks &= run % 2 == 0
    return marks


def _steps(data):
    """+1 for brackets that open, -1 for those that close."""
    import numpy as np

    table = np.zeros(256, np.int8)
    table[[b for b in b"{["]], table[[b for b in b"}]"]] = 1, -1
    return table[data]


def _backslashes(file, start: int) -> int:
    """How many backslashes end right before ``start``."""
    n = 0
    while start > n:
        size = min(64, start - n)
        file.seek(start - n - size)
        block = file.read(size)
        kept = block.rstrip(b"\\")
        n += len(block) - len(kept)
        if kept:
            break
    return n


def _counted(system, path: str, start: int, length: int, json: bool) -> tuple[int, int, int]:
    """(quotes, change of depth if the range begins outside a string, the same if inside)."""
    import numpy as np

    with system.open_input_file(path) as file:
        before = _backslashes(file, start) if json else 0
        file.seek(start)
        data = np.frombuffer(file.read(length), np.uint8)
    if not json:
        return int((data == _QUOTE).sum()), 0, 0
    marks = _quotes(data, before)
    inside, steps = np.cumsum(marks) % 2, _steps(data)
    return int(marks.sum()), int(steps[inside == 0].sum()), int(steps[inside == 1].sum())


def _csv_records(system, path: str, start: int, length: int, inside: int, depth: int) -> Iterator[bytes]:
    """Records that start in a range, without their line ends; a file's first is its header and left out, as are empty ones."""
    import numpy as np

    with system.open_input_file(path) as file:
        file.seek(max(0, start - 1))
        # the byte before the range is the end of a record if it is a line end outside quotes
        begins = start > 0 and file.read(1) == b"\n" and not inside
        file.seek(start)
        block, at, step, parts = file.read(length), start, min(length, _BEYOND), [] if begins else None
        while block:
            data = np.frombuffer(block, np.uint8)
            state = (np.cumsum(data == _QUOTE) + inside) % 2
            since = 0
            for end in np.flatnonzero((data == _NEWLINE) & (state == 0)).tolist():
                if parts is not None and (record := b"".join([*parts, block[since:end]]).removesuffix(b"\r")):
                    yield record
                parts, since = [], end + 1
                if at + since >= start + length:
                    return
            at += len(block)
            if parts is not None:
                parts.append(block[since:])
            elif at >= start + length:
                return
            inside, block = int(state[-1]), file.read(step := min(2 * step, _BEYOND))
        if parts is not None and (record := b"".join(parts).removesuffix(b"\r")):
            yield record


def _json_elements(system, path: str, start: int, length: int, inside: int, depth: int) -> Iterator[bytes]:
    """Objects and arrays at depth 1 that start in a range."""
    import numpy as np

    with system.open_input_file(path) as file:
        before = _backslashes(file, start)
        file.seek(start)
        block, at, step, parts = file.read(length), start, min(length, _BEYOND), None
        while block:
            data = np.frombuffer(block, np.uint8)
            state = (np.cumsum(_quotes(data, before)) + inside) % 2
            steps = np.where(state == 0, _steps(data), 0)
            level = depth + np.cumsum(steps, dtype=np.int64)
            opened = np.flatnonzero((steps == 1) & (level == 2))
            closed = np.flatnonzero((steps == -1) & (level == 1))
            bounds = sorted([(p, True) for p in opened.tolist()] + [(p, False) for p in closed.tolist()])
            since = 0
            for p, opens in bounds:
                if opens:
                    if at + p >= start + length:
                        return
                    parts, since = [], p
                elif parts is not None:
                    yield b"".join([*parts, block[since : p + 1]])
                    parts = None
            if parts is None and at + len(block) >= start + length:
                return
            if parts is not None:
                parts.append(block[since:])
            trailing = len(block) - len(block.rstrip(b"\\"))
            before = before + trailing if trailing == len(block) else trailing
            inside, depth, at = int(state[-1]), int(level[-1]), at + len(block)
            block = file.read(step := min(2 * step, _BEYOND))


def shared(files: list[tuple[str, int]], range_bytes: int, tasks: int) -> tuple[int, int]:
    """(neighbouring ranges that lie in one task, tasks): one where there are few or large ranges, else as many as make
    ``tasks`` of all bytes, but no more than RANGE_BYTES a task."""
    total = sum(size for _, size in files)
    group = max(1, min(RANGE_BYTES, total // tasks) // range_bytes)
    n = sum(-(-size // (group * range_bytes)) for _, size in files)
    return group, max(1, min(n, max(tasks, -(-total // (group * range_bytes)))))


def records(spark: SparkSession, uri: str, json: bool, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(value) each record of CSV files without their headers, or each object or array in the arrays of JSON files.

    Quotes are as RFC 4180 and JSON have them. No file may be compressed.
    """
    files = files_of(uri)
    if packed := [p for p, _ in files if p.endswith((".gz", ".zst", ".bz2", ".xz"))]:
        raise ValueError(f"{packed[0]} is compressed: ranges of it can't be read")
    group, n = shared(files, range_bytes, max(TASKS, 2 * spark.sparkContext.defaultParallelism))
    ranges = spark.createDataFrame(files, "path string, bytes long").select("path", F.explode(F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)")).alias("start"))
    # a task's ranges lie side by side
    spread = lambda df: df.repartition(n, "path", F.expr(f"start div {group * range_bytes}")).sortWithinPartitions("path", "start")

    def count(batches):
        import pyarrow as pa

        system, _ = _system(uri)
        for batch in batches:
            rows = [(r["path"], r["start"], *_counted(system, r["path"], r["start"], range_bytes, json)) for r in batch.to_pylist()]
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["path", "start", "quotes", "outside", "inside"])

    def read(batches):
        import pyarrow as pa

        system, _ = _system(uri)
        find: Callable = _json_elements if json else _csv_records
        for batch in batches:
            held, size = [], 0
            for r in batch.to_pylist():
                for x in find(system, r["path"], r["start"], range_bytes, r["within"], r["depth"]):
                    held.append(x)
                    size += len(x)
                    if size > 1 << 23:
                        yield pa.record_batch([pa.array(held).cast(pa.string())], names=["value"])
                        held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(held).cast(pa.string())], names=["value"])

    earlier = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("long")
    counted = spread(ranges).mapInArrow(count, "path string, start long, quotes long, outside long, inside long")
    begun = counted.withColumn("within", before("quotes") % 2)
    begun = begun.withColumn("change", F.when(F.col("within") == 0, F.col("outside")).otherwise(F.col("inside")))
    begun = begun.select("path", "start", "within", before("change").alias("depth"))
    return spread(begun).mapInArrow(read, "value string")


def header(uri: str) -> list[str]:
    """Column names of the first CSV file."""
    import csv
    import io

    system, _ = _system(uri)
    path, size = files_of(uri)[0]
    with system.open_input_file(path) as file:
        first = b""
        while len(first) < size:
            first += file.read(_BEYOND)
            text, parity = first.decode(errors="ignore").removeprefix("﻿"), 0
            for line in text.splitlines(True):
                parity ^= line.count('"') % 2
                if not parity and line.endswith("\n"):
                    return next(csv.reader(io.StringIO(text, newline="")))
    return next(csv.reader(io.StringIO(text, newline="")))
