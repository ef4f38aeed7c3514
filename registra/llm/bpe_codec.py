"""BPE encoding by a bounded-lookahead streaming transducer, and decoding by an incremental state machine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from . import common
from .bpe import TextDecoder, Units, UnitTable, as_bytes, blocks, merge_list

_known: dict[str, UnitTable] = {}


def _units(path: str) -> tuple[Units, UnitTable]:
    merges = merge_list(path)
    if path not in _known:
        _known[path] = UnitTable(lambda units: [as_bytes(merges.encode_unit(u)) for u in units], b"", most=600_000)
    return Units(merges.special), _known[path]


def encoded_blocks(text: str | None, path: str, block: int = 8_192) -> Iterator[bytes]:
    """Token ids of a text as little-endian unsigned 32-bit integers, block by block as they become stable.

    Characters enter in stretches that end with a pre-token; a pre-token longer than a stretch enters in pieces, and
    its tokens leave once they lie ``lookahead`` bytes behind. So beyond the text itself, memory is that of a block.
    """
    merges = merge_list(path)
    cut, known = _units(path)
    pieces = blocks(text or "", merges.special, block)
    for unfinished, piece in pieces:
        if not unfinished:
            yield b"".join(v for spaced, parts in cut.segments(piece) for v in known.values(spaced, parts))
            continue

        def chunks(first=piece):
            while first:
                yield first.encode("utf-8", "replace")
                first = next(pieces)[1]

        tokens = merges.stream(chunks())
        while ids := list(islice(tokens, block)):
            yield as_bytes(ids)


def encode_text(text: str | None, path: str) -> bytes:
    """Token ids of a whole text as little-endian unsigned 32-bit integers."""
    return b"".join(encoded_blocks(text, path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of each whole text; a null or empty text has no ids."""

    def run(batches):
        import numpy as np

        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [np.frombuffer(encode_text(t, path), "<u4").astype("int32") for t in batch["text"]]})

    return common.by_row(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of each row of ids; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            texts = []
            for ids in batch["ids"]:
                decoder = TextDecoder(merge_list(path))
                texts.append(decoder.feed(() if ids is None else ids) + decoder.finish())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    return common.by_row(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(text: str | None, path: str, block: int = 8_192) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the ids, SHA-256 of what they decode to), of which nothing is held as a whole."""
    from array import array

    decoder, of_ids, of_text, n = TextDecoder(merge_list(path)), hashlib.sha256(), hashlib.sha256(), 0
    for ids in encoded_blocks(text, path, block):
        n += len(ids) // 4
        of_ids.update(ids)
        of_text.update(decoder.feed(array("I", ids)).encode())
    of_text.update(decoder.finish().encode())
    return n, of_ids.hexdigest(), of_text.hexdigest()


def codec_digests(docs: DataFrame, path: str, block: int = 8_192) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded, block by block.

    Null and empty texts have no ids and decode to the empty text. Repeated rows give repeated results; other
    columns are ignored; an empty table gives an empty result. Texts and pre-tokens of any length stream through.
    """

    def run(batches):
        for batch in batches:
            rows = [(doc_id, *digests(text, path, block)) for doc_id, text in zip(batch["doc_id"], batch["text"])]
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.by_row(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return codec_digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
