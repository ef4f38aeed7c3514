"""Near-duplicate vectors by codes of random rotations with stored correction factors.

Each vector is rotated at random and coded by the signs of its coordinates; a stored factor says how far the code
points along the vector. A code and another vector's coordinates give an unbiased estimate of their inner product
with a known error, and only pairs whose estimate does not rule out a link are computed again exactly.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CODE_BITS, ERRORS, SEED = 192, 5.0, 11
_rotations: dict = {}


def rotations(dim: int, bits: int):
    """Random rotations side by side (dim x bits, whole rotations), the same in every task."""
    import numpy as np

    turns = -(-bits // dim)
    if (dim, turns) not in _rotations:
        random = np.random.RandomState(SEED + dim)
        _rotations[dim, turns] = np.hstack([np.linalg.qr(random.normal(size=(dim, dim)))[0] for _ in range(turns)])
    return _rotations[dim, turns]


def plan(n: int, threshold: float, lost: float = 1e-4) -> tuple[int, int]:
    """(bits of a band, bands): buckets of a few random vectors, and a link at the threshold lost with chance ``lost``."""
    same = 1 - math.acos(threshold) / math.pi
    bits = max(8, math.ceil(math.log2(max(2, n))) - 2)
    return bits, math.ceil(math.log(lost) / math.log1p(-(same**bits)))


def _unit(arrays):
    import numpy as np

    x = np.stack(arrays).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def coded(vectors: DataFrame, bits: int, bands: int) -> DataFrame:
    """(id, dim, bands, code, factors) for rows (id, v): band keys, sign bits of the first rotations and, for each of
    these, the inner product of a vector with its code."""

    def run(batches):
        import numpy as np

        weights = (np.uint64(1) << np.arange(bits, dtype=np.uint64)).astype(np.uint64)
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                turned = _unit(part["v"].to_numpy()) @ rotations(dim, max(CODE_BITS, bits * bands))
                sign = turned > 0
                key = (sign[:, : bits * bands].reshape(len(part), bands, bits) * weights).sum(axis=2, dtype=np.uint64)
                key ^= (np.arange(bands, dtype=np.uint64) + np.uint64(dim * 4096)) << np.uint64(40)
                turns = -(-CODE_BITS // dim)
                packed = np.packbits(np.pad(sign[:, : turns * dim], ((0, 0), (0, -turns * dim % 64))), axis=1, bitorder="little")
                factors = np.abs(turned[:, : turns * dim]).reshape(len(part), turns, dim).sum(axis=2) / dim**0.5
                yield pd.DataFrame({"id": part["id"], "dim": dim, "bands": list(key.view(np.int64)), "code": list(packed.view(np.int64)), "factors": list(factors)})

    return vectors.mapInPandas(run, "id long, dim int, bands array<long>, code array<long>, factors array<double>")


def estimate(v, code, factors):
    """Unbiased estimates of inner products of unit vectors ``v`` with coded ones, row by row, and their errors."""
    import numpy as np

    dim, turns = v.shape[1], factors.shape[1]
    sign = np.unpackbits(np.ascontiguousarray(code).view(np.uint8), axis=1, bitorder="little")[:, : turns * dim] * 2.0 - 1
    along = ((v @ rotations(dim, turns * dim)) * sign).reshape(len(v), turns, dim).sum(axis=2) / dim**0.5
    spread = np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / max(1, dim - 1))
    return (along / factors).mean(axis=1), np.sqrt((spread**2).sum(axis=1)) / turns


def _confirm(pairs: DataFrame, codes: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    def screen(batches):
        import numpy as np

        for batch in batches:
            for _, part in batch.groupby(batch["v"].map(len)):
                guess, error = estimate(_unit(part["v"].to_numpy()), np.stack(part["code"].to_numpy()), np.stack(part["factors"].to_numpy()))
                yield part.loc[guess + ERRORS * error >= threshold, ["a", "b"]]

    def exact(batches):
        for batch in batches:
            for _, part in batch.groupby(batch["v"].map(len)):
                keep = (_unit(part["v"].to_numpy()) * _unit(part["w"].to_numpy())).sum(axis=1) >= threshold
                yield part.loc[keep, ["a", "b"]].assign(link=True, d=None)

    one = pairs.join(codes.select(F.col("id").alias("b"), "dim", "code", "factors"), "b")
    one = one.join(vectors.select(F.col("id").alias("a"), "v"), "a").where(F.size("v") == F.col("dim"))
    open_ = common.materialize(one.select("a", "b", "v", "code", "factors").mapInPandas(screen, "a long, b long"), "candidates")
    both = open_.join(vectors.select(F.col("id").alias("b"), F.col("v").alias("w")), "b").join(vectors.select(F.col("id").alias("a"), "v"), "a")
    return both.select("a", "b", "v", "w").mapInPandas(exact, "a long, b long, link boolean, d double")


def _close_codes(x: str, y: str, threshold: float):
    """Whether two codes differ in few enough bits: five standard deviations more than a link at the threshold."""
    p = math.acos(threshold) / math.pi
    differ = F.lit(0)
    for i in range(CODE_BITS // 64):
        differ = differ + F.bit_count(F.get(F.col(f"{x}.code"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{y}.code"), F.lit(i))))
    return (F.col(f"{x}.dim") == F.col(f"{y}.dim")) & (differ <= int(CODE_BITS * p + 5 * (CODE_BITS * p * (1 - p)) ** 0.5))


def _linked(rows: pd.DataFrame, cols: pd.DataFrame, threshold: float):
    """Matrix of the links between vectors of two tiles; estimates tell which cosines are computed."""
    import numpy as np

    v, w = _unit(rows["v"].to_numpy()), _unit(cols["v"].to_numpy())
    code, factors = np.stack(cols["code"].to_numpy()), np.stack(cols["factors"].to_numpy())
    linked = np.zeros((len(v), len(w)), bool)
    dim, turns = v.shape[1], factors.shape[1]
    sign = np.unpackbits(np.ascontiguousarray(code).view(np.uint8), axis=1, bitorder="little")[:, : turns * dim] * np.float32(2) - 1
    scaled = (sign.reshape(-1, turns, dim) / (factors[:, :, None] * dim**0.5 * turns)).reshape(len(w), -1)
    error = np.sqrt((np.maximum(1 - factors**2, 0) / factors**2).sum(axis=1) / max(1, dim - 1)) / turns
    turned = v @ rotations(dim, turns * dim)
    for at in range(0, len(v), 256):
        part = slice(at, at + 256)
        may = turned[part] @ scaled.T + ERRORS * error >= threshold
        if may.mean() > 0.05:
            linked[part] = may & (v[part] @ w.T >= threshold)
        else:
            x, y = np.nonzero(may)
            linked[x + at, y] = (v[x + at] * w[y]).sum(axis=1) >= threshold
    return linked


def _tiles(members: DataFrame, keys: list[str], sizes: DataFrame, tile: int) -> DataFrame:
    """``members`` dealt out for all pairs of chunks (i, j) of a group, each of at most about ``tile`` rows.

    A large group meets itself in many tasks, and no pair of rows is made outside a task.
    """
    dealt = members.join(sizes, keys).withColumn("chunks", F.ceil(F.col("size") / tile).cast("int"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    return met.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("other", "chunks", "size")


def _link_counts(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(id, n): for rows (component, id, copies, v, code, factors), the copies of linked vectors in the component.

    Links lie within components, so these alone are compared.
    """

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        rows, cols = pdf[pdf["chunk"] == i], pdf[pdf["chunk"] == j]
        if not len(rows) or not len(cols):
            return pd.DataFrame({"id": [], "n": []})
        linked = _linked(rows, cols, threshold)
        if i == j:
            np.fill_diagonal(linked, False)
        out = [pd.DataFrame({"id": rows["id"], "n": linked @ cols["copies"].to_numpy()})]
        if i != j:
            out.append(pd.DataFrame({"id": cols["id"], "n": linked.T @ rows["copies"].to_numpy()}))
        return pd.concat(out)

    keys = ["component", "dim"]
    tiles = _tiles(members, keys, members.groupBy(*keys).agg(F.count("*").alias("size")), tile)
    tiles = tiles.select(*keys, "i", "j", "chunk", "id", "copies", "v", "code", "factors")
    return tiles.groupBy(*keys, "i", "j").applyInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _settled(rows: DataFrame, codes: DataFrame, vectors: DataFrame, threshold: float, tile: int, large: int = 64) -> DataFrame:
    """Links (a, b) across components among rows (band, id, component) of one band.

    Buckets of up to ``large`` rows are joined with themselves, and pairs that their codes leave open are confirmed.
    Larger buckets, as a dense topic fills them, are compared in tiles that emit links only.
    """
    rows = rows.select("band", "id", "component")
    sizes = common.materialize(rows.groupBy("band").agg(F.count("*").alias("size")), "sizes")
    few = rows.join(sizes.where(F.col("size") <= large).select("band"), "band").join(codes.select("id", "dim", "code"), "id")
    apart = F.expr("x.band = y.band AND x.id < y.id AND x.component != y.component")
    pairs = few.alias("x").join(few.alias("y"), apart & _close_codes("x", "y", threshold))
    pairs = common.materialize(pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "pairs")

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        found = []
        for _, part in pdf.groupby("dim"):
            one, two = part[part["chunk"] == part["i"]], part[part["chunk"] == part["j"]]
            if not len(one) or not len(two):
                continue
            linked = _linked(one, two, threshold)
            linked &= one["component"].to_numpy()[:, None] != two["component"].to_numpy()
            x, y = np.nonzero(linked)
            # one link between a vector and a component is enough
            links = pd.DataFrame({"a": one["id"].to_numpy()[x], "b": two["id"].to_numpy()[y], "c": two["component"].to_numpy()[y]})
            found.append(links.drop_duplicates(["a", "c"])[["a", "b"]])
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []})

    many = sizes.where(F.col("size") > large)
    tiles = _tiles(rows.join(many.select("band"), "band"), ["band"], many, tile)
    tiles = tiles.join(codes.select("id", "dim", "code", "factors"), "id").join(vectors.select("id", "v"), "id")
    columns = ["band", "i", "j", "chunk", "id", "component", "dim", "v", "code", "factors"]
    dense = tiles.select(*columns).groupBy("band", "i", "j").applyInPandas(across, "a long, b long")
    return _confirm(pairs, codes, vectors, threshold).select("a", "b").unionByName(dense.distinct())


@common.written("components")
def near_duplicates(vectors: DataFrame, threshold: float = 0.95, tile: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each vector.

    Vectors are linked if their cosine, in double precision, is at least ``threshold``. Equal vectors are one from
    the start. Bands of sign bits find candidates, found at the threshold with probability 0.9999, and components
    as components_by_bands() says; links are then counted exactly within each component.

    A vector that is null, empty, all zero, or has a null or non-finite component is linked with nothing; vectors of
    different lengths are not linked. So is one without a vec_id, whose component is null. Rows that share a vec_id count as one in components and are returned once
    each. Other columns, labels too, are ignored; an empty table gives an empty result.
    """
    e = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    key = F.when(F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull(), F.concat_ws(" ", F.hex(F.xxhash64(e)), F.hex(F.xxhash64(F.lit(1), e))))
    rows = rows.withColumn("key", F.coalesce(key, F.concat(F.lit("alone "), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))))
    rows = common.materialize(rows.withColumn("good", key.isNotNull() & F.col("vec_id").isNotNull()), "vectors")
    # the vector comes last: the smallest id decides, equal keys mean equal vectors
    classes = rows.where("good").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.any_value("v").alias("v"))
    classes = common.materialize(classes, "classes")
    bits, bands = plan(classes.count(), threshold)
    codes = common.materialize(coded(classes.select("id", "v"), bits, bands), "codes")
    labels = common.components_by_bands(
        codes.select("id", "bands"), lambda p: _confirm(p, codes, classes, threshold), lambda rows: _settled(rows, codes, classes, threshold, tile)
    )
    labels = common.materialize(labels, "labels")
    members = labels.join(classes.drop("key"), "id").join(codes.select("id", "dim", "code", "factors"), "id")
    counts = _link_counts(members, threshold, tile)
    known = classes.select("key", "id", "copies").join(labels, "id", "left").join(counts, "id", "left")
    known = known.select("key", F.coalesce("component", "id").alias("c"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))
