"""Byte-level BPE on the worker: units, merge list, a bounded-lookahead encoder and an incremental decoder."""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator

import regex

#: Fixed value: the pattern by which byte-level BPE vocabularies of this family split a text.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_pre_tokens = regex.compile(PRE_TOKENS)
_double_space = re.compile(r"\s\s")


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabulary files, as symbol -> byte.

    Visible Latin-1 characters stand for themselves, the other bytes for code points from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Units:
    """Cuts a text into units whose encodings do not depend on their neighbours.

    Without two white-space characters in a row, a text can be cut before each single blank: a blank then always
    begins a pre-token. Other texts are cut into the pre-tokens themselves. Special strings are units of their own.
    """

    def __init__(self, special: dict[str, int]):
        self.special = special
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def segments(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """(whether a blank stands before each part but the first, parts) for each stretch; specials come alone."""
        stretches = self._special.split(text) if self._special and any(s in text for s in self.special) else [text]
        for stretch in stretches:
            if not stretch:
                continue
            if stretch in self.special:
                yield False, [stretch]
            elif _double_space.search(stretch):
                yield False, _pre_tokens.findall(stretch)
            else:
                yield True, stretch.split(" ")


def _last_blank(part: str) -> int:
    """The last single blank between other characters, before which a pre-token ends; 0 if there is none."""
    at = part.rfind(" ", 1, -1)
    while at > 0 and (part[at - 1].isspace() or part[at + 1].isspace()):
        at = part.rfind(" ", 1, at)
    return max(at, 0)


def _last_end(part: str) -> int:
    """The end of the last pre-token of a part that what follows can't change; 0 if there is none.

    White space at an end would read otherwise, so a cut follows another character.
    """
    last = 0
    for m in _pre_tokens.finditer(part):
        if m.end() > len(part) - 4:
            break
        last = last if part[m.end() - 1].isspace() else m.end()
    return last


def blocks(text: str, special: dict[str, int], size: int) -> Iterator[tuple[bool, str]]:
    """The text cut into stretches that encode alike alone: (whether it is one unfinished pre-token's piece, piece).

    A stretch of about ``size`` characters ends where a pre-token does, whatever follows: at its last one that ends
    four characters or more before what was read, since no rule looks further ahead. A pre-token that alone fills a
    stretch comes piece by piece, and then an empty piece that ends it. Special strings are stretches of their own.
    """
    marks = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
    found = marks.finditer(text) if marks and any(s in text for s in special) else iter(())
    at, more = 0, True
    while more:
        mark = next(found, None)
        more, end = mark is not None, len(text) if mark is None else mark.start()
        while at < end:
            if end - at <= size:
                yield False, text[at:end]
                break
            part = text[at : at + size]
            if cut := _last_blank(part) or _last_end(part):
                yield False, part[:cut]
                at += cut
                continue
            stop = _pre_tokens.match(text, at, end).end()
            if text[stop - 1].isspace():
                # a run of white space: its last character may belong to what follows, so all of it is read at once
                while stop < end and text[stop].isspace():
                    stop += 1
                stop = min(end, stop + 1)
                after = _pre_tokens.match(text, stop - 1, end) if stop < end else None
                stop = stop if after is None else after.end()
                yield False, text[at:stop]
                at = stop
                continue
            for first in range(at, stop, size):
                yield True, text[first : min(stop, first + size)]
            yield True, ""
            at = stop
        if mark:
            yield False, mark.group()
            at = mark.end()


class UnitTable:
    """unit -> value, by a fixed first tier and a bounded cache filled by ``encode(list of units)``.

    Units preceded by a blank and others are kept apart, so no string is built for a lookup. A full cache ages: its
    entries are asked once more before they go, so units that still occur stay.
    """

    def __init__(self, encode, empty, first_tier: tuple[dict, dict] = ({}, {}), most: int = 500_000, longest: int = 64):
        self.encode, self.empty, self.first_tier, self.most, self.longest = encode, empty, first_tier, most, longest
        self.now: list[dict] = [dict(t) for t in first_tier]
        self.aged: list[dict] = [{}, {}]

    def values(self, spaced: bool, parts: list[str]) -> list:
        if not spaced:
            return self._look(0, parts)
        head = self._look(0, parts[:1]) if parts[0] else [self.empty]
        return head + self._look(1, parts[1:])

    def _look(self, spaced: int, parts: list[str]) -> list:
        known, aged = self.now[spaced], self.aged[spaced]
        found = list(map(known.get, parts))
        if None not in found:
            return found
        missing = {p: aged.get(p) for p, v in zip(parts, found) if v is None}
        unknown = [p for p, v in missing.items() if v is None]
        if unknown:
            missing.update(zip(unknown, self.encode([" " + p for p in unknown] if spaced else unknown)))
        if len(known) + len(missing) > self.most // 2:
            self.aged[spaced], self.now[spaced] = known, (known := dict(self.first_tier[spaced]))
        known.update((p, v) for p, v in missing.items() if len(p) <= self.longest)
        return [missing[p] if v is None else v for p, v in zip(parts, found)]


class MergeList:
    """Vocabulary and merges of a byte-level BPE file, with the lookahead that suffices for stable tokens."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int] | None = None):
        self.special = special or {}
        self.bytes_of = {i: t for t, i in tokens.items()} | {i: s.encode() for s, i in self.special.items()}
        self.ids = tokens
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (x, y) in enumerate(merges):
            self.ranks.setdefault((tokens[x], tokens[y]), (rank, tokens[x + y]))
        self.first = [tokens.get(bytes([b])) for b in range(256)]
        self.lookahead = sufficient_lookahead(merges)

    @classmethod
    def from_file(cls, path: str) -> MergeList:
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        to_byte = byte_symbols()
        special = {t["content"]: t["id"] for t in read["added_tokens"]}
        raw = lambda s: bytes(to_byte[c] for c in s)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in read["model"]["merges"]]
        tokens = {raw(t): i for t, i in read["model"]["vocab"].items() if t not in special}
        return cls(tokens, [(raw(x), raw(y)) for x, y in merges], special)

    def merge(self, piece: bytes) -> list[int]:
        """All merges of the list applied to a short piece: lowest rank first, leftmost first."""
        ids = [self.first[b] for b in piece]
        ranks = self.ranks
        if len(ids) > 64:
            return self._merge_by_heap(ids)
        while len(ids) > 1:
            best, at = None, -1
            for i in range(len(ids) - 1):
                r = ranks.get((ids[i], ids[i + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _merge_by_heap(self, ids: list[int]) -> list[int]:
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live: list[int | None] = list(ids)
        heap = [(r[0], i, r[1], ids[i], ids[i + 1]) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, merged, x, y = heapq.heappop(heap)
            j = after[i] if live[i] == x else n
            if j >= n or live[j] != y:
                continue
            live[i], live[j] = merged, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := ranks.get((merged, live[k])):
                    heapq.heappush(heap, (r[0], i, r[1], merged, live[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((live[h], merged))):
                heapq.heappush(heap, (r[0], h, r[1], live[h], merged))
        return [x for x in live if x is not None]

    def stream(self, chunks: Iterable[bytes], block: int = 256) -> Iterator[int]:
        """Token ids of one pre-token that arrives in chunks, in memory bounded by block + lookahead.

        A token whose end lies at least ``lookahead`` bytes before the end of what was read can't change any more:
        whatever follows, no chain of merges reaches back to it. Such tokens leave; the rest is merged again with
        the bytes that come next.
        """
        held = bytearray()
        for chunk in chunks:
            for start in range(0, len(chunk), block):
                held += chunk[start : start + block]
                if len(held) < block + self.lookahead:
                    continue
                stable, end = len(held) - self.lookahead, 0
                for token in self.merge(bytes(held)):
                    if end + len(self.bytes_of[token]) > stable:
                        break
                    end += len(self.bytes_of[token])
                    yield token
                del held[:end]
        yield from self.merge(bytes(held))

    def encode_unit(self, unit: str) -> list[int]:
        if unit in self.special:
            return [self.special[unit]]
        out: list[int] = []
        for pre_token in _pre_tokens.findall(unit):
            raw = pre_token.encode("utf-8", "replace")
            out += self.stream([raw])
        return out


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a token's end beyond which nothing can change the token.

    A merge (x, y) fails to happen if y, or a part of y that ends where y ends, is first taken by a merge to its
    right, one of lower rank; that merge depends in turn on merges of still lower rank further right. Ranks fall
    along such a chain, so the reach of each merge follows from those before it in the list. A final token can be
    taken by any merge that it begins.
    """
    parts = {}
    begins: dict[bytes, tuple[list[int], list[int]]] = {}  # left side -> ranks, largest reach up to each
    longest = 0
    for rank, (x, y) in enumerate(merges):
        reach, end, taken_at = 0, y, rank
        while end is not None:
            if end in begins:
                ranks, reaches = begins[end]
                lo, hi = 0, len(ranks)
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if ranks[mid] < taken_at else (lo, mid)
                if lo:
                    reach = max(reach, reaches[lo - 1])
            taken_at, end = parts.get(end, (0, None))
        ranks, reaches = begins.setdefault(x, ([], []))
        ranks.append(rank)
        reaches.append(max(len(y) + reach, reaches[-1] if reaches else 0))
        longest = max(longest, reaches[-1])
        parts.setdefault(x + y, (rank, y))
    return longest + 1


class TextDecoder:
    """Token ids to text, piece by piece: bytes of an unfinished character wait for the next token."""

    def __init__(self, merges: MergeList):
        self._bytes = merges.bytes_of
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._state.decode(b"".join(map(self._bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self._state.decode(b"", True)


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


_loaded: dict[str, MergeList] = {}


def merge_list(path: str) -> MergeList:
    """The merge list of a file, read once for each worker."""
    if path not in _loaded:
        _loaded[path] = MergeList.from_file(path)
    return _loaded[path]
