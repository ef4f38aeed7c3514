"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

STATISTICS = (
    "log_words", "word_length", "distinct_words", "top_word", "repeats", "distinct_pairs", "upper", "digits", "symbols",
    "rare_symbols", "ends_with_symbol", "bars", "stops", "commas", "lines", "line_length", "distinct_lines", "top_line", "symbol_kinds",
)
FEATURES, RIDGE, BINS, SEED = 256, 1e-3, 512, 7


def statistics(text: str | None) -> list[float]:
    """Numbers that describe how a text is written; no word, language or name enters. All 0 for a text without words."""
    import math
    from collections import Counter

    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, raw, m = len(words), text.encode("utf-8", "surrogatepass"), max(1, len(text))
    count = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    upper = sum(map(str.isupper, words))
    symbols = len(raw.translate(None, _PLAIN))
    rare = len(raw.translate(None, _PLAIN + b".,;:'\"-()?!"))
    kinds = len(set(raw.translate(None, _PLAIN)))
    tails = sum(1 for w in words if not w[-1].isalnum())
    lines = [x for x in text.split("\n") if x.strip()]
    per_line = Counter(lines)
    return [
        math.log1p(n), min(30.0, m / n), len(count) / n, max(count.values()) / n, sum(map(str.__eq__, words, words[1:])) / n,
        pairs / n, upper / n, sum(raw.count(d) for d in _DIGITS) / m, symbols / m, rare / m, tails / n, text.count("|") / n,
        text.count(".") / n, text.count(",") / n, math.log1p(len(lines)), math.log1p(m / max(1, len(lines))),
        len(per_line) / max(1, len(lines)), max(per_line.values(), default=0) / max(1, len(lines)), kinds / 10,
    ]


_DIGITS = [bytes([d]) for d in range(48, 58)]
#: Bytes that are no symbols: letters, digits, white space, and all that belongs to characters beyond ASCII.
_PLAIN = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b).isspace())


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each whole text."""

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"]]})

    return common.by_row(docs.select("doc_id", "text"), run, "doc_id long, x array<double>")


def _summed(rows: DataFrame, parts) -> dict[int, float]:
    """Sums of the arrays that ``parts(batch)`` gives for each batch, added up in each task, then over tasks."""

    def run(batches):
        import numpy as np

        total = None
        for batch in batches:
            if len(batch):
                part = parts(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total), dtype="int64"), "v": total})

    return {r.i: r.v for r in rows.mapInPandas(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}


def _waves(x, model):
    import numpy as np

    z = np.clip((x - model["mean"]) / model["spread"], -6, 6)
    return np.cos(z @ model["w"] + model["phase"]) * (2 / FEATURES) ** 0.5


def _raw(x, model):
    return _waves(x, model) @ model["beta"] + model["intercept"]


def fit(labelled: DataFrame) -> dict | None:
    """Ridge on Fourier features by normal equations that each task sums up, then isotonic calibration.

    ``labelled`` has x array<double> and y double; all rows take part. The driver gets sums of a fixed size only:
    moments, a matrix of FEATURES squared, and positives and rows in BINS bins of the raw score. None if no rows.
    """
    import numpy as np

    d = len(STATISTICS)
    stack = lambda batch: np.stack(batch["x"].to_numpy())
    moments = _summed(labelled.select("x", "y"), lambda b: np.concatenate([[len(b), b["y"].sum()], stack(b).sum(0), (stack(b) ** 2).sum(0)]))
    if not moments:
        return None
    m = np.array([moments[i] for i in range(2 + 2 * d)])
    n, mean = m[0], m[2 : 2 + d] / m[0]
    spread = np.sqrt(np.maximum(m[2 + d :] / n - mean**2, 1e-12))
    random = np.random.RandomState(SEED)
    model = {"mean": mean, "spread": np.maximum(spread, 1e-4), "w": random.normal(size=(d, FEATURES)) * 0.35, "phase": random.uniform(0, 2 * np.pi, FEATURES)}
    base, upper = m[1] / n, np.triu_indices(FEATURES)

    def equations(batch):
        z = _waves(stack(batch), model)
        return np.concatenate([(z.T @ z)[upper], z.T @ (batch["y"].to_numpy() - base), z.sum(0)])

    sums = _summed(labelled.select("x", "y"), equations)
    s = np.array([sums[i] for i in range(len(sums))])
    a, k = np.zeros((FEATURES, FEATURES)), len(upper[0])
    a[upper] = s[:k]
    a = a + a.T - np.diag(np.diag(a))
    centre = s[k + FEATURES :] / n
    a -= n * np.outer(centre, centre)
    model["beta"] = np.linalg.solve(a + RIDGE * n / FEATURES * np.eye(FEATURES), s[k : k + FEATURES])
    model["intercept"] = base - centre @ model["beta"]

    def binned(batch):
        at = np.clip(((_raw(stack(batch), model) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, batch["y"].to_numpy(), BINS)]).astype(float)

    sums = _summed(labelled.select("x", "y"), binned)
    counts = np.array([sums[i] for i in range(2 * BINS)])
    model["levels"] = isotonic(counts[BINS:] + base, counts[:BINS] + 1.0)
    return model


def isotonic(positives, rows):
    """Rising levels closest to positives / rows, by pooling neighbours that fall; each bin has a row of the base rate."""
    import numpy as np

    blocks: list[list[float]] = []
    for p, n in zip(positives, rows):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / n) for p, n, k in blocks])


def score(rows: DataFrame, model: dict | None, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for rows (doc_id, held_out, x). Without a model every score is 0.5."""
    model = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np

        for batch in batches:
            if not len(batch):
                continue
            out = batch[["doc_id", "held_out"]].copy()
            if model.value is None:
                out["score"] = 0.5
            else:
                raw = _raw(np.stack(batch["x"].to_numpy()), model.value)
                at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
                # within a level, a small slope keeps the order of raw scores
                level = model.value["levels"][at]
                out["score"] = np.clip(level * 0.998 + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)
            out["predicted"] = (out["score"] >= threshold).astype("int32")
            yield out

    return common.by_row(rows.select("doc_id", "held_out", "x"), run, "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text; empty and null texts have all statistics 0.

    Calibration is isotonic over BINS fixed bins of the raw score.

    Learns from labels of documents whose crc32(doc_id as text) modulo ``folds`` is not ``held_out``; null labels
    teach nothing, and several labels of one document count as their mean. Repeated rows are scored each; other
    columns are ignored; without labels every score is 0.5; an empty table gives an empty result.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    rows = described(docs).withColumn("held_out", F.coalesce(fold == held_out, F.lit(False)))
    rows = common.materialize(rows, "statistics")
    marks = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    labelled = common.materialize(rows.where("NOT held_out").join(marks, "doc_id").select("x", "y"), "labelled")
    return score(rows, fit(labelled), threshold)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
