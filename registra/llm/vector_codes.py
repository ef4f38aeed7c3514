"""Codes of vectors: each of 16 parts becomes the number of the nearest entry of its codebook, in whole numbers.

The nearest entry is sought by annular norm pruning: entries are sorted by norm; whatever lies nearer to a part than
the best entry so far differs in norm by no more than that distance, an interval that is found by binary search, and
only the entries in it, its ends included, are evaluated, exactly. Codebooks are sums of fixed size; vectors never
leave their tasks.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Pairs of a part and an entry that are evaluated at once in a task.
PAIRS = 1 << 18


def most_whole(dim: int) -> int:
    """Components are to lie below this, so that errors of a vector of ``dim`` components fit 64 bits."""
    return 1 << ((60 - max(1, dim).bit_length()) // 2)


def whole(vectors, scale: int = SCALE):
    """floor(scale * x) of stacked vectors."""
    import numpy as np

    return np.floor(np.stack(vectors).astype(np.float64) * scale).astype(np.int64)


def nearest(x, entries):
    """(index, squared distance) of the entry nearest to each row of ``x``, ties to the lower index.

    Norms are doubles, widened by more than their rounding; distances are whole numbers.
    """
    import numpy as np

    norms = np.sqrt((entries.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(norms, kind="stable")
    sorted_norms, own = norms[order], np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    # first bests: the three entries whose norms are about the part's own
    middle = np.searchsorted(sorted_norms, own)
    tried = order[np.clip(middle[:, None] + np.arange(-1, 2), 0, len(entries) - 1)]
    best = np.sqrt(((x[:, None, :] - entries[tried]) ** 2).sum(axis=2).min(axis=1).astype(np.float64))
    slack = 1e-9 * (1 + own + best)
    low = np.searchsorted(sorted_norms, own - best - slack, side="left")
    high = np.searchsorted(sorted_norms, own + best + slack, side="right")
    index, apart = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    ends = np.cumsum(high - low)
    at = 0
    while at < len(x):
        # as many rows as have PAIRS entries in their annuli, one at least
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        wide = (high - low)[at:to]
        starts = np.cumsum(wide) - wide
        row = np.repeat(np.arange(at, to), wide)
        entry = order[np.arange(len(row)) - np.repeat(starts, wide) + np.repeat(low[at:to], wide)]
        d = ((x[row] - entries[entry]) ** 2).sum(axis=1)
        apart[at:to] = np.minimum.reduceat(d, starts)
        index[at:to] = np.minimum.reduceat(np.where(d == np.repeat(apart[at:to], wide), entry, len(entries)), starts)
        at = to
    return index, apart


def _assign(vectors, codebooks, scale: int):
    """Whole parts (rows x parts x components), and the index and squared distance of each part's entry."""
    import numpy as np

    x = whole(vectors, scale)
    x = x.reshape(len(x), len(codebooks), -1)
    found = [nearest(x[:, j], codebooks[j]) for j in range(len(codebooks))]
    return x, np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _improved(kept: DataFrame, codebooks, scale: int):
    """Codebooks whose entries are the means of their parts, rounded down; unused ones stay.

    Tasks send sums of fixed size, one row for each part and entry that they use.
    """
    import numpy as np

    parts, entries, width = codebooks.shape

    def run(batches):
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if len(batch):
                x, index, _ = _assign(batch["v"].to_numpy(), codebooks, scale)
                for j in range(parts):
                    part = np.zeros((entries, width), np.int64)
                    np.add.at(part, index[:, j], x[:, j])
                    sums[j] += part
                    counts[j] += np.bincount(index[:, j], minlength=entries)
        part, entry = np.nonzero(counts)
        if len(part):
            yield pd.DataFrame({"part": part, "entry": entry, "n": counts[part, entry], "sums": [[str(s) for s in sums[p, e]] for p, e in zip(part, entry)]})

    found = kept.select("v").mapInPandas(run, "part int, entry int, n long, sums array<string>")
    total = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    out = codebooks.copy()
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
        out[r.part, r.entry] = [int(r[f"s{k}"]) // int(r.n) for k in range(width)]
    return out


def _kept(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """(vec_id, label, v) of the vectors that take part, of the commonest length among those that could."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(sound, F.lit(False)) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    length = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = length.dim if length else 0
    return rows.where((F.size("v") == dim) & F.forall("v", lambda x: F.abs(x) * scale < float(most_whole(dim))))


@common.written("codes")
def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector that takes part.

    Components become floor(scale * x), vectors ``parts`` equal parts. Each part's codebook begins as that part of the
    ``entries`` smallest vec_ids (fewer if there are fewer vectors; equal ids go by their vectors, NULL ids last).
    Each round assigns all parts to their nearest entries and replaces these by means, rounded down; then they are
    assigned once more. The error is the sum of squared distances, the label's that of all vectors with it, NULLs
    together. Vectors that are NULL, hold NULL or no finite components, can't be cut, have another length than most, or
    components beyond most_whole() (2^18 for 64 components at scale 256) are left out. Repeated rows are coded each;
    other columns are ignored; an empty table gives an empty result.
    """
    import numpy as np

    kept = common.materialize(_kept(vectors, parts, scale), "vectors")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    if not first:
        return kept.selectExpr("vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    start = whole([np.array(r.v) for r in first], scale)
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _improved(kept, books, scale)
    told = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def run(batches):
        for batch in batches:
            if len(batch):
                _, index, apart = _assign(batch["v"].to_numpy(), books, scale)
                coded = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
                yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "code": coded, "error": apart.sum(axis=1)})

    # ids and labels pass as text: with nulls among them pandas would round whole numbers of 64 bits
    text = kept.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("label").cast("string").alias("label"), "v")
    coded = common.materialize(text.mapInPandas(run, "vec_id string, label string, code string, error long"), "coded")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    out = coded.alias("c").join(sums.alias("s"), F.expr("c.label <=> s.label"))
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(told).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes(common.table(spark, sf_dir, "embeddings"))
