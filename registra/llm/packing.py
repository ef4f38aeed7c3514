"""Packing of token sequences by minimum bin slack with bitset subset-sum dynamic programming."""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import common
from .bpe import Units, UnitTable
from .token_counts import _library, specials, unit_encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_encoded: dict = {}


def closest_fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths, of those that ``counts`` holds, whose sum comes closest to ``room`` from below.

    Bit s of ``reach`` says that a sum s can be made. Lengths enter largest first with their counts split into
    powers of two; the states before each entry are kept, and walked back to tell how often a length is used.
    """
    reach, whole, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & whole
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] += take
    return used


class Packer:
    """Fills sequences from the rests of documents; ``emit`` gets a list of (rest, first, length) for each."""

    def __init__(self, size: int, emit):
        self.size, self.emit, self.by_length, self.total = size, emit, defaultdict(list), 0

    def add(self, rest, first: int, length: int) -> None:
        self.by_length[length].append((rest, first))
        self.total += length

    def _take(self, length: int):
        rest, first = self.by_length[length].pop()
        if not self.by_length[length]:
            del self.by_length[length]
        self.total -= length
        return rest, first, length

    def fill(self, down_to: int) -> None:
        """Fill whole sequences while more than ``down_to`` tokens wait; a gap that is left takes a cut piece."""
        while self.total >= max(self.size, down_to):
            chosen = [self._take(max(self.by_length))]
            room = self.size - chosen[0][2]
            for length, n in closest_fill(room, {x: len(v) for x, v in self.by_length.items()}).items():
                for _ in range(n):
                    chosen.append(self._take(length))
                room -= n * length
            if room:
                rest, first, length = self._take(min(x for x in self.by_length if x > room))
                chosen.append((rest, first, room))
                self.add(rest, first + room, length - room)
            self.emit(chosen)

    def finish(self) -> None:
        """The last, shorter than a sequence, goes in sequences of a power of two each, which need no padding."""
        self.fill(0)
        power = self.size
        while self.total:
            power = 1 << (self.total.bit_length() - 1)
            chosen, room = [], power
            while room:
                rest, first, length = self._take(max(self.by_length))
                if length > room:
                    self.add(rest, first + room, length - room)
                    length = room
                chosen.append((rest, first, length))
                room -= length
            self.emit(chosen)


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 0, wait: int = 2_048) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    A document is its ids and then ``end_id``; a null or empty text is that id alone. Its whole stretches of
    ``size`` ids become sequences; its rest is packed with up to ``wait`` others of the same task by minimum bin
    slack, and only where no multiset fills the gap is a piece cut. Each task packs its own rows, without any
    shuffle, and numbers sequences from partition * 2^32, so a task that runs again gives the same rows. At most
    ten sequences of a task are shorter than ``size``, each of a power of two. ``size`` is a power of two. Repeated
    rows are packed as often as they occur; other columns are ignored; an empty table gives no piece.
    """
    special = specials(path)
    kind, letter, width = ("<u2", "H", 2) if _library(path).get_vocab_size() <= 1 << 16 else ("<u4", "I", 4)

    def run(batches):
        import numpy as np

        if path not in _encoded:
            encode = unit_encoder(path)
            ids_of = lambda units: [array(letter, ids).tobytes() for ids in encode(units)]
            _encoded[path] = UnitTable(ids_of, b"", most=800_000)
        cut, known, rows = Units(special), _encoded[path], []
        numbers = iter(range((TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 1 << 63))

        def emit(pieces):
            number, offset = next(numbers), 0
            for (doc_id, ids, n), first, length in pieces:
                start = n - len(ids) + first
                rows.append((doc_id, start, length, zlib.crc32(ids[first : first + length].astype("<u4").tobytes()), n, number, offset))
                offset += length

        packer, waiting = Packer(size, emit), 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                parts = [v for spaced, p in cut.segments(text or "") for v in known.values(spaced, p)]
                ids = np.frombuffer(b"".join(parts) + end_id.to_bytes(width, "little"), kind)
                n, whole = len(ids), len(ids) // size * size
                for first in range(0, whole, size):
                    emit([((doc_id, ids, n), first, size)])
                if whole < n:
                    packer.add((doc_id, ids[whole:].copy(), n), 0, n - whole)
                    waiting += 1
                if waiting >= wait:
                    packer.fill(8 * size)
                    waiting = 0
            yield _frame(rows)
            rows.clear()
        packer.finish()
        yield _frame(rows)

    return common.by_row(docs.select("doc_id", "text"), run, PIECES)


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
