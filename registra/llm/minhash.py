"""Near-duplicate documents by b-bit MinHash: bands find candidates, packed low bits estimate, full sets decide."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BITS, ROWS, BANDS = 4, 6, 32
HASHES = ROWS * BANDS
FEATURES = "doc_id long, n_shingles long, key string, bands array<long>, signature array<long>"


def shingle_set(text: str | None, width: int = 2):
    """Sorted distinct 64-bit hashes of a text's word shingles; with fewer words, of the whole sequence as one."""
    import numpy as np
    import xxhash

    words = common.words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    if len(h) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 7)], np.uint64)
    out = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def features(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: the size of its set, a 128-bit key of it, band values and low bits of the minima."""

    def run(batches):
        import numpy as np
        import xxhash

        random = np.random.RandomState(20_240_101)
        a = random.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        b = random.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shingle_set(text, width)
                if not len(found):
                    rows.append((doc_id, 0, f"empty {doc_id}", None, None))
                    continue
                x, least = (found >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
                for at in range(0, len(x), 1024):
                    np.minimum(least, (x[at : at + 1024, None] * a + b).min(axis=0), out=least)
                band = np.arange(BANDS, dtype=np.uint64)
                for row in least.reshape(BANDS, ROWS).T.astype(np.uint64):
                    band = (band * np.uint64(0x9E3779B97F4A7C15)) ^ row
                    band ^= band >> np.uint64(31)
                low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint8)
                packed = (low[0::2] | low[1::2] << BITS).view(np.int64)
                rows.append((doc_id, len(found), xxhash.xxh3_128_hexdigest(found.tobytes()), band.view(np.int64), packed))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "key", "bands", "signature"])

    return common.by_row(docs.select("doc_id", "text"), run, FEATURES)


def likely(a: Column, b: Column, threshold: float) -> Column:
    """Whether the share of equal minima, corrected for low bits that agree by chance, may reach the threshold.

    Four standard deviations are allowed for, so three links in 100,000 at the threshold are lost here at most.
    """
    differ = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(x)
    chance = 2.0**-BITS
    least = threshold - 4 * (threshold * (1 - threshold) / HASHES) ** 0.5
    return differ <= F.lit(int(HASHES * (1 - (least * (1 - chance) + chance))))


def _confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, link, d) of the pairs whose packed signatures leave it open: d is 1 - similarity of the full sets."""
    of = lambda side: reps.select(F.col("id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}"))
    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    pairs = pairs.join(of("b"), "b").join(of("a"), "a").where(close & likely(F.col("s_a"), F.col("s_b"), percent / 100))
    pairs = common.materialize(pairs.select("a", "b"), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # ids that grow with the corpus are merged with it at every size, never broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    texts = common.materialize(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")

    def run(batches):
        import numpy as np

        last, of_last = None, None
        for batch in batches:
            rows = []
            for a, b, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
                if of_last is None or text_a != last:
                    last, of_last = text_a, shingle_set(text_a, width)
                other = shingle_set(text_b, width)
                shared = len(np.intersect1d(of_last, other, assume_unique=True))
                union = len(of_last) + len(other) - shared
                rows.append((a, b, 100 * shared >= percent * union, 1 - shared / max(1, union)))
            yield pd.DataFrame(rows, columns=["a", "b", "link", "d"])

    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long, link boolean, d double")


def overlaps(xs: list, ys: list, abreast: int = 4096):
    """Sizes of the intersections of all sets ``xs`` (sorted distinct hashes) with all sets ``ys``, as a matrix.

    Hashes that many sets hold are counted by products of incidence matrices, ``abreast`` at a time, the others pair
    by pair of the sets that hold them.
    """
    import numpy as np

    out = np.zeros((len(xs), len(ys)), np.int64)
    hash_x, hash_y = np.concatenate([*xs, np.empty(0, np.uint64)]), np.concatenate([*ys, np.empty(0, np.uint64)])
    both = np.intersect1d(hash_x, hash_y)
    if not len(both):
        return out

    def held(hashes, sets):
        at = np.minimum(np.searchsorted(both, hashes), len(both) - 1)
        real = both[at] == hashes
        column, row = at[real], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[real]
        order = np.argsort(column, kind="stable")
        return column[order], row[order]

    (col_x, row_x), (col_y, row_y) = held(hash_x, xs), held(hash_y, ys)
    n_x, n_y = np.bincount(col_x, minlength=len(both)), np.bincount(col_y, minlength=len(both))
    common_ones = n_x * n_y > 256
    place = np.cumsum(common_ones) - 1
    n_common = int(common_ones.sum())
    abreast = max(1, min(abreast, n_common))
    for at in range(0, n_common, abreast):
        sides = []
        for col, row, n in ((col_x, row_x, len(xs)), (col_y, row_y, len(ys))):
            here = common_ones[col] & (place[col] >= at) & (place[col] < at + abreast)
            side = np.zeros((n, abreast), np.float32)
            side[row[here], place[col[here]] - at] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    rare = ~common_ones[col_x]
    col, row, first = col_x[rare], row_x[rare], np.cumsum(n_y) - n_y
    for at in range(0, len(col), 16_384):
        c, r = col[at : at + 16_384], row[at : at + 16_384]
        times = n_y[c]
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        other = row_y[np.repeat(first[c], times) + step]
        out += np.bincount(np.repeat(r, times) * len(ys) + other, minlength=out.size).reshape(out.shape)
    return out


def _settle(unsettled: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int, tile: int = 256, tile_bytes: int = 1 << 24) -> DataFrame:
    """Links (a, b) across components among documents that share buckets with one smallest id.

    Documents outside that one's component are compared with all others, each pair under the least of the smallest
    ids that both meet. They meet in tiles of a bounded number of rows, and of bytes but for single longer texts; no
    pair leaves a task unless it is a link, and one link between a document and a component is enough.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(unsettled.select("id").distinct().hint("merge"), "id", "left_semi")
    texts = common.materialize(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
    mets = unsettled.groupBy("id").agg(F.array_sort(F.collect_set("a")).alias("mets"))
    sized = unsettled.join(texts.select("id", F.octet_length("text").cast("long").alias("bytes")), "id")
    home = F.max(F.when(F.col("id") == F.col("a"), F.col("component")))
    homes = sized.groupBy("a").agg(home.alias("home"), F.count("*").alias("n"), F.sum("bytes").alias("n_bytes"))
    rows = sized.join(homes, "a").withColumn("stray", F.col("component") != F.col("home"))
    strays = rows.where("stray").groupBy("a").agg(F.count("*").alias("n_strays"), F.sum("bytes").alias("stray_bytes"))
    rows = rows.join(strays, "a").join(reps.select("id", "signature", "n_shingles"), "id").join(mets, "id").join(texts, "id")
    parts = lambda n, size, most: F.ceil(F.greatest(F.col(n) / most, F.col(size) / tile_bytes)).cast("int")
    rows = rows.withColumns({"across": parts("n", "n_bytes", 2 * tile), "down": parts("n_strays", "stray_bytes", tile)})
    place = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = rows.where("stray").withColumn("i", place("down")).withColumn("j", every("across")).withColumn("side", F.lit(0))
    right = rows.withColumn("j", place("across")).withColumn("i", every("down")).withColumn("side", F.lit(1))
    columns = ["a", "i", "j", "side", "id", "component", "stray", "d", "n_shingles", "signature", "mets", "text"]
    reach = 1 - percent / 100
    chance = 2.0**-BITS
    least = HASHES * ((percent / 100 - 4 * (percent / 100 * reach / HASHES) ** 0.5) * (1 - chance) + chance)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        def lows(part):
            """A column for each value that the low bits of each minimum can have."""
            packed = np.stack(part["signature"].to_numpy()).view(np.uint8)
            each = np.concatenate([packed & 15, packed >> 4], axis=1)
            return (each[:, :, None] == np.arange(1 << BITS, dtype=np.uint8)).reshape(len(each), -1).astype(np.float32)

        x, y = pdf[pdf["side"] == 0].reset_index(drop=True), pdf[pdf["side"] == 1].reset_index(drop=True)
        none = pd.DataFrame({"a": [], "b": []})
        if not len(x) or not len(y):
            return none
        col = lambda c, kind: (x[c].to_numpy(kind)[:, None], y[c].to_numpy(kind)[None, :])
        (id_x, id_y), (home_x, home_y), (n_x, n_y), (d_x, d_y) = col("id", np.int64), col("component", np.int64), col("n_shingles", np.int64), col("d", np.float64)
        # of two strays, the smaller id compares
        ask = (home_x != home_y) & ~(y["stray"].to_numpy(bool)[None, :] & (id_y < id_x))
        ask &= ~(abs(d_x - d_y) > reach + 1e-9) & (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))
        ask &= lows(x) @ lows(y).T >= least
        a = pdf["a"].iloc[0]
        before = [[np.asarray(m)[np.asarray(m) < a].astype(np.int64).view(np.uint64) for m in part["mets"]] for part in (x, y)]
        ask &= overlaps(*before) == 0
        rows, cols = np.nonzero(ask.any(axis=1))[0], np.nonzero(ask.any(axis=0))[0]
        if not len(rows):
            return none
        xs, ys = ([shingle_set(t, width) for t in part["text"].to_numpy()[chosen]] for part, chosen in ((x, rows), (y, cols)))
        shared = overlaps(xs, ys)
        union = np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys])[None, :] - shared
        r, c = np.nonzero(ask[np.ix_(rows, cols)] & (100 * shared >= percent * union))
        found = pd.DataFrame({"a": id_x[rows[r], 0], "b": id_y[0, cols[c]], "component": home_y[0, cols[c]]})
        return found.drop_duplicates(["a", "component"])[["a", "b"]]

    # a tile is small but its work is not: a stated number of partitions is not coalesced by their sizes
    tiles = left.select(*columns).unionByName(right.select(*columns)).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "i", "j")
    return tiles.groupBy("a", "i", "j").applyInPandas(compare, "a long, b long")


@common.written("components")
def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document.

    Documents are linked if 100 * intersection >= percent * union of their sets of word shingles. Equal sets meet
    by their key first, so a group of copies is one representative (its smallest doc_id) from then on; bands of
    minima then find components as components_by_bands() says. The bands find a pair at similarity 0.8 with
    probability 0.99994, and more similar ones more surely.

    Documents without words (null, empty or blank texts) have n_shingles 0 and are components of their own. Rows
    that share a doc_id count as one document in components and are returned once each; where their texts differ, the
    least of them is compared. Rows without a doc_id are components of their own, with a null one. Other columns are
    ignored; an empty table gives an empty result.
    """
    table = common.materialize(features(docs, width), "features")
    reps = table.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature")).alias("r"))
    reps = common.materialize(reps.select("key", F.col("r.doc_id").alias("id"), "r.n_shingles", "r.bands", "r.signature"), "representatives")

    items = reps.select("id", "bands")
    labels = common.components_by_bands(
        items, lambda pairs: _confirm(pairs, reps, docs, width, percent), lambda rows: _settle(rows.drop("band").distinct(), reps, docs, width, percent)
    )
    known = reps.select("key", "id").join(labels, "id", "left").select("key", F.coalesce("component", "id").alias("component_id"))
    out = table.select("doc_id", "n_shingles", "key").join(known, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), width=2)
