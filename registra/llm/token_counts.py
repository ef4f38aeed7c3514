"""Token counts by a two-tier lookup on the map side: a broadcast table of frequent units, then worker caches."""

from __future__ import annotations

import uuid
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .bpe import PRE_TOKENS, Units, UnitTable, merge_list

_tokenizers: dict = {}
_tables: dict = {}
_encoders: dict = {}


def _library(path: str):
    """The tokenizer of a file, once for each worker; as the library would, but on the task's own thread."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            _tokenizers[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            _tokenizers[path] = t
    return _tokenizers[path]


def specials(path: str) -> dict[str, int]:
    return {t.content: i for i, t in _library(path).get_added_tokens_decoder().items()}


def cuts_into_units(path: str) -> bool:
    """Whether the file is a byte-level BPE without normalizer, whose units can be looked up one by one."""
    import json

    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        read = json.load(f)
    split = read.get("pre_tokenizer") or {}
    plain = not any(t[k] for t in read["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return plain and not read["normalizer"] and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]


def unit_encoder(path: str):
    """list of units -> list of their ids, for units outside every cache.

    Where the vocabulary's ids follow its merge list, the faster encoder for such rank files gives the same ids.
    """
    if path not in _encoders:
        merges = merge_list(path)
        made = [i for _, i in sorted(merges.ranks.values())]
        if made == sorted(made) and sorted(merges.ids.values()) == list(range(len(merges.ids))):
            import tiktoken

            fast = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=merges.ids, special_tokens={})._core_bpe.encode_ordinary
            special = {s: [i] for s, i in merges.special.items()}
            _encoders[path] = lambda units: [special.get(u) or fast(u) for u in units]
        else:
            library = _library(path)
            _encoders[path] = lambda units: [e.ids for e in library.encode_batch_fast(units, add_special_tokens=False)]
    return _encoders[path]


def _lengths(path: str):
    encode = unit_encoder(path)
    return lambda units: [len(ids) for ids in encode(units)]


def frequent_units(texts: DataFrame, path: str, most: int = 32_768, of_a_task: int = 4_096) -> tuple[dict, dict]:
    """Token lengths of the units that are most frequent in all texts, at most ``most`` of them.

    Each task counts the units of its rows, thinning its counts as it goes to a fixed size, and passes on its
    ``of_a_task`` largest; only these sums are shuffled and merged. The table bounds memory and sets speed, never a
    result.
    """
    room, special = 16 * of_a_task, specials(path)

    def heavy(batches):
        cut, counts = Units(special), (Counter(), Counter())
        for batch in batches:
            for text in batch["text"]:
                for spaced, parts in cut.segments(text or ""):
                    counts[0].update(parts[:1] if spaced else parts)
                    counts[1].update(parts[1:] if spaced else ())
            for c in counts:
                if len(c) > room:
                    kept = c.most_common(room // 2)
                    c.clear()
                    c.update(dict(kept))
        rows = [(bool(k), u, n) for k in (0, 1) for u, n in counts[k].items() if u and len(u) <= 64]
        rows.sort(key=lambda r: -r[2])
        if rows:
            yield pd.DataFrame(rows[:of_a_task], columns=["spaced", "unit", "n"])

    summed = texts.select("text").mapInPandas(heavy, "spaced boolean, unit string, n long").groupBy("spaced", "unit").agg(F.sum("n").alias("n"))
    rows = summed.orderBy(F.desc("n"), "spaced", "unit").limit(most).collect()
    out: tuple[dict, dict] = ({}, {})
    lengths = _lengths(path)([" " * r.spaced + r.unit for r in rows])
    for r, n in zip(rows, lengths):
        out[r.spaced][r.unit] = n
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 1024, most_frequent: int = 32_768) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each whole text; a null or empty text has 0 of either.

    Rows stay where they are: but for the sums of frequent_units(), of a fixed number for each task, no pre-token is
    shuffled. Rows without a doc_id are counted, too. Repeated rows give repeated results, other columns of
    ``docs`` are ignored, an empty table gives an empty result, and texts of any length are counted whole.
    """
    spark, texts = docs.sparkSession, docs.select("doc_id", "text")
    unit_wise = cuts_into_units(path)
    tier = spark.sparkContext.broadcast(frequent_units(texts, path, most_frequent)) if unit_wise else None
    special = specials(path) if unit_wise else {}
    key = uuid.uuid4().hex

    def count(batches):
        if not unit_wise:
            library = _library(path)
            for batch in batches:
                whole = [t or "" for t in batch["text"]]
                n = [len(library.encode(t)) if path.endswith(".model") else len(library.encode(t, add_special_tokens=False)) for t in whole]
                yield _counted(batch, n, limit)
            return
        if key not in _tables:
            _tables.clear()
            _tables[key] = UnitTable(_lengths(path), 0, tier.value, most=1_000_000)
        cut, known = Units(special), _tables[key]
        for batch in batches:
            n = [sum(sum(known.values(spaced, parts)) for spaced, parts in cut.segments(t or "")) for t in batch["text"]]
            yield _counted(batch, n, limit)

    return common.by_row(texts, count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _counted(batch: pd.DataFrame, n: list[int], limit: int) -> pd.DataFrame:
    size = [len((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"]]
    return pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": size, "n_tokens": n, "over_limit": [x > limit for x in n]})


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
