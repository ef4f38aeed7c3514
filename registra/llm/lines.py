"""Fuzzy line dedup: MinHash over character shingles, bands, exact Jaccard, union-find. Only DataFrame functions."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

ROWS, BANDS, SEED = 4, 11, 3
HASHES = ROWS * BANDS
#: Shingles that one row brings to an aggregation: minima of a row are taken before its group is looked up.
ABREAST = 8
#: A sketch adds up 96 lanes of +1 and -1, three in a word of 21 bits each, for half the words from either hash.
WORDS, LANES, DEVIATIONS = 32, 3, 4.0
PIVOTS = 8
#: Lines of a bucket that are compared with each other directly; few, so that the work for larger ones, which is in
#: proportion to their lines, is nearly all of it at every size.
DIRECT = 8


def _masks(n: int) -> list[int]:
    """A 32-bit mask for each of ``n`` hash functions: a shingle's rank under it is its hash XOR the mask.

    Top bits differ from mask to mask, so the minima of a set are taken from different parts of its hashes.
    """
    rnd = random.Random(SEED)
    return [((j * (1 << 32) // n) ^ rnd.getrandbits(32 - n.bit_length())) - (1 << 31) for j in range(n)]


def _last(width: int) -> str:
    """Index of the last shingle of ``wide``, a line of two bytes for each character, so that a shingle is cut out in
    constant time; a line shorter than a shingle is one as a whole."""
    return f"greatest(0, octet_length(wide) div 2 - {width})"


def signed(lines: DataFrame, width: int) -> DataFrame:
    """(id, bands) for rows (id, line), of which id is distinct: keys of the minima of all shingles of a line."""
    wide = lines.select("id", F.encode("line", "UTF-16BE").alias("wide")).withColumn("last", F.expr(_last(width)))
    rows = wide.select("*", F.explode(F.expr(f"sequence(0, last div {ABREAST})")).alias("part"))
    # places past the end stand for the last shingle again, which changes no minimum
    each = [F.expr(f"hash(substring(wide, 2 * least(last, {ABREAST} * part + {i}) + 1, {2 * width}))").alias(f"h{i}") for i in range(ABREAST)]
    hashed = rows.select("id", *each)
    least = [F.min(F.least(*[F.col(f"h{i}").bitwiseXOR(F.lit(m)) for i in range(ABREAST)])).alias(f"m{j}") for j, m in enumerate(_masks(HASHES))]
    minima = hashed.groupBy("id").agg(*least)
    # masks of one band lie far apart: near ones choose the same shingle of a short line
    bands = [F.xxhash64(F.lit(b), *[f"m{b + BANDS * r}" for r in range(ROWS)]) for b in range(BANDS)]
    return minima.select("id", F.array(*bands).alias("bands"))


def _shingles(width: int) -> Column:
    """The set of hashes of all shingles of ``line``; the outer transform encodes the line once for all of them."""
    each = f"transform(sequence(0, {_last(width)}), i -> xxhash64(substring(wide, 2 * i + 1, {2 * width})))"
    return F.expr(f"get(transform(array(encode(line, 'UTF-16BE')), wide -> array_distinct({each})), 0)")


def sketched(lines: DataFrame, width: int) -> DataFrame:
    """Rows (id, line), of which id is distinct, with ``n``, the size of the set of shingles, and ``sketch``.

    Each lane of a sketch counts the shingles for which one bit of a hash is set, that is, adds up +1 and -1.
    """
    sets = lines.select("id", _shingles(width).alias("hashes"))
    rows = sets.select("*", F.explode(F.expr(f"sequence(0, (size(hashes) - 1) div {ABREAST})")).alias("part"))
    each = [F.expr(f"get(hashes, {ABREAST} * part + {i})").alias(f"h{i}") for i in range(ABREAST)]
    rows = rows.select("id", *each)
    bits = [F.when(F.col(f"h{i}").isNull(), 0).otherwise(F.xxhash64(f"h{i}", F.lit(k))).alias(f"x{i}_{k}") for i in range(ABREAST) for k in (0, 1)]
    rows = rows.select("id", reduce(Column.__add__, [F.col(f"h{i}").isNotNull().cast("int") for i in range(ABREAST)]).alias("n"), *bits)
    lanes = F.lit(sum(1 << 21 * k for k in range(LANES)))

    def word(j: int) -> Column:
        return reduce(Column.__add__, [F.shiftrightunsigned(F.col(f"x{i}_{j % 2}"), j // 2).bitwiseAND(lanes) for i in range(ABREAST)])

    # a sum that outgrows its word is null, and rules nothing out
    sums = rows.groupBy("id").agg(F.sum("n").alias("n"), *[F.try_sum(word(j)).alias(f"s{j}") for j in range(WORDS)])
    return lines.join(sums.select("id", "n", F.array(*[f"s{j}" for j in range(WORDS)]).alias("sketch")), "id")


def _may(x: str, y: str, percent: int) -> Column:
    """Whether sizes and sketches of aliased rows leave a link open, with four deviations to spare.

    Squares of the differences of lanes estimate the symmetric difference of two sets, of which sets that are linked
    share out at most (1 - s) / (1 + s) of their added sizes. The relative deviation of the estimate is sqrt(2 / lanes).
    """
    lanes, mask = WORDS * LANES, (1 << 21) - 1
    lane = lambda v, k: f"(shiftrightunsigned({v}, {21 * k}) & {mask})"
    apart = ", ".join(f"2 * ({lane('a', k)} - {lane('b', k)}) - ({x}.n - {y}.n)" for k in range(LANES))
    total = f"aggregate(flatten(zip_with({x}.sketch, {y}.sketch, (a, b) -> array({apart}))), 0D, (s, d) -> s + d * d)"
    share = (100 - percent) / (100 + percent) * lanes * (1 + DEVIATIONS * (2 / lanes) ** 0.5)
    close = F.expr(f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)")
    return close & F.expr(f"coalesce({total} <= {share} * ({x}.n + {y}.n), true)")


def _linked(x: str, y: str, width: int, percent: int) -> Column:
    """Whether the sets of shingles of the lines of aliased rows are similar by ``percent`` or more."""

    def shingles(side: str) -> str:
        each = f"transform(sequence(0, {_last(width)}), i -> xxhash64(substring(wide, 2 * i + 1, {2 * width})))"
        return f"get(transform(array(encode({side}.line, 'UTF-16BE')), wide -> array_distinct({each})), 0)"

    shared = F.expr(f"size(array_intersect({shingles(x)}, {shingles(y)}))")
    return shared * (100 + percent) >= F.expr(f"{percent} * ({x}.n + {y}.n)")


def _confirmed(pairs: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that are linked: the last join decides, so no other pair leaves it."""
    one = pairs.join(known.select(F.col("id").alias("b"), F.struct("line", "n", "sketch").alias("y")), "b")
    two = known.select(F.col("id").alias("a"), F.struct("line", "n", "sketch").alias("x"))
    return one.join(two, "a").where(_may("x", "y", percent) & _linked("x", "y", width, percent)).select("a", "b")


def _rare_pairs(lines: DataFrame, width: int, percent: int, tile: int = 512) -> DataFrame:
    """Pairs (a, b) that may be linked among rows (id, line, n, component, met), in other components and in one of the
    same buckets ``met``.

    Shingles stand in one order for all lines: first those of a single component, which no pair can share, then the
    others, the rarest first. The first that two lines share ends what they can have in common: the rest of either line
    from there on. So lines that keep many shingles for themselves meet none of their template. Of each line only the
    shingles that can be such a first one are joined; those that more than ``tile`` lines bring are joined in tiles.
    """
    several = F.min("component") < F.max("component")
    each = lines.select("id", "component", F.explode(_shingles(width)).alias("h"))
    met = each.groupBy("h").agg(F.count("*").alias("f"), several.alias("several")).where("several").drop("several")
    held = each.drop("component").join(met, "h")
    held = held.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("f", "h")))
    held = held.withColumn("shared", F.count("*").over(W.partitionBy("id"))).join(lines.select("id", "n", "component", "met"), "id")
    held = held.withColumn("at", F.expr("n - shared + rank - 1")).where(f"100 * (n - at) >= {percent} * n")
    held = common.materialize(held.drop("f", "rank", "shared"), "rare")
    times = held.groupBy("h").agg(F.ceil(F.count("*") / tile).cast("int").alias("t"), several.alias("several"))
    held = held.join(times.where("several").drop("several"), "h")
    place, every = F.pmod(F.xxhash64("id"), F.col("t")).cast("int"), F.explode(F.expr("sequence(0, t - 1)"))
    x, y = held.withColumn("i", place).withColumn("j", every), held.withColumn("j", place).withColumn("i", every)
    once = F.expr("x.h = y.h AND x.i = y.i AND x.j = y.j AND x.id < y.id AND x.component != y.component")
    close = F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    reach = F.expr(f"{100 + percent} * least(x.n - x.at, y.n - y.at) >= {percent} * (x.n + y.n)")
    met = x.alias("x").join(y.alias("y"), once & close & reach & F.expr("arrays_overlap(x.met, y.met)"))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _settled(rows: DataFrame, items: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) across components among rows (band, id, component) of one band.

    Every line is first compared with a few others of its bucket; what these links join needs no comparison. Those
    that still lie apart are compared by the sketches, each pair in the first of the bands they share, and by the sets
    where the sketches leave a link open; no pair leaves the join unless it is a link. In buckets of more than
    ``DIRECT`` lines, only pairs that share a rare shingle are, by _rare_pairs().
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(PIVOTS)).alias("slot")
    pivots = rows.groupBy("band", slot).agg(F.min("id").alias("p"), F.min_by("component", "id").alias("c"))
    met = rows.join(pivots.drop("slot"), "band").where("component != c")
    pairs = common.materialize(met.select(F.least("p", "id").alias("a"), F.greatest("p", "id").alias("b")).distinct(), "pairs")
    found = common.materialize(_confirmed(pairs, known, width, percent), "links")
    label = rows.select("id", "component").distinct()
    of = lambda side: label.select(F.col("id").alias(side), F.col("component").alias(f"c_{side}"))
    joined = found.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    merged = common.connected_components(joined).select(F.col("id").alias("component"), F.col("component").alias("m"))
    rows = rows.select("band", "id", "component").join(merged, "component", "left")
    rows = rows.select("band", "id", F.coalesce("m", "component").alias("component"))
    apart = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n_lines")).where("low < high")
    rows = common.materialize(rows.join(apart.select("band", "n_lines"), "band"), "apart")

    few = rows.where(f"n_lines <= {DIRECT}").join(known, "id").join(items, "id")
    few = few.select("band", "id", "component", "bands", "line", "n", "sketch")
    once = F.expr("x.band = y.band AND x.id < y.id AND x.component != y.component")
    first = F.expr("get(array_intersect(x.bands, y.bands), 0) = x.band")
    rest = few.alias("x").join(few.alias("y"), once & first & _may("x", "y", percent) & _linked("x", "y", width, percent))
    rest = common.materialize(rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "links")

    many = rows.where(f"n_lines > {DIRECT}").groupBy("id").agg(F.min("component").alias("component"), F.collect_set("band").alias("met"))
    many = common.materialize(many.join(known.select("id", "line", "n"), "id"), "many")
    rare = common.materialize(_rare_pairs(many, width, percent), "pairs")
    more = common.materialize(_confirmed(rare, known, width, percent), "links")
    for used in (pairs, rows, many, rare):
        common.discard(used)
    return found.unionByName(rest).unionByName(more)


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, at, line) of all lines that are not blank."""
    split = docs.select(F.col("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return split.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _key(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def duplicate_lines(docs: DataFrame, width: int = 8, percent: int = 80) -> DataFrame:
    """(doc_id, at, class_doc_id): each line (numbered from 0) that repeats one kept elsewhere.

    Equal lines are one from the start; lines whose sets of ``width``-character shingles are similar by ``percent``
    or more are linked, and of each component of links the first line stays: that of the smallest doc_id, and there
    the topmost. Minima are taken over all shingles; bands find a pair at similarity 0.8 with probability 0.997, at
    0.9 with 0.99998. Characters are UTF-16 units.
    """
    lines = _occurrences(docs).groupBy("line").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"))
    lines = common.materialize(lines.withColumn("id", F.monotonically_increasing_id()), "lines")
    banded = common.materialize(signed(lines, width), "bands")
    tables = [banded]

    def known_of(pairs: DataFrame) -> DataFrame:
        if len(tables) == 1:
            ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            tables.append(common.materialize(lines.select("id", "line").join(ids, "id", "left_semi"), "wanted"))
            tables.append(common.materialize(sketched(tables[-1], width), "sketches"))
        return tables[-1]

    labels = common.components_by_bands(
        banded,
        lambda pairs: _confirmed(pairs, known_of(pairs), width, percent).select("*", F.lit(True).alias("link"), F.lit(None).cast("double").alias("d")),
        lambda rows: _settled(rows, banded, tables[-1], width, percent),
    )
    # a line is hashed where it lies; the join takes its keys, not its text
    classed = lines.select("id", "doc_id", "times", *_key("line")).join(labels, "id", "left").where("component IS NOT NULL OR times > 1")
    classed = classed.select(F.coalesce("component", "id").alias("class"), "doc_id", "k1", "k2")
    classed = common.materialize(classed, "classes")
    for used in (lines, *tables):
        common.discard(used)
    keepers = classed.groupBy("class").agg(F.min("doc_id").alias("class_doc_id"))
    classed = classed.drop("doc_id").join(keepers, "class")
    found = _occurrences(docs).select("doc_id", "at", *_key("line")).join(classed, ["k1", "k2"])
    first = F.row_number().over(W.partitionBy("doc_id", "class").orderBy("at")) == 1
    found = found.withColumn("kept", first & (F.col("doc_id") == F.col("class_doc_id")))
    return found.where("NOT kept").select("doc_id", "at", "class_doc_id")


@common.written("removed", broadcasts=False)
def _removed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    removed = duplicate_lines(docs, width, percent)
    return removed.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("at").alias("_removed"))


def dedup(docs: DataFrame, width: int = 8, percent: int = 80) -> DataFrame:
    """``docs`` with ``text`` freed of duplicate lines, and columns n_lines and n_kept for each document.

    Lines end at a line feed; a carriage return belongs to its line. Lines of nothing but white space (space and
    x09 to x0D) are never compared and stay. A null text stays null with 0 lines, an empty text has one (blank)
    line. A document that loses all its lines keeps an empty text. Rows that share a doc_id are taken for one
    document: the same line numbers go from each. Rows without a doc_id stay as they are. An empty table gives an
    empty result; other columns pass unchanged, but for n_lines and n_kept, which are set anew.
    """
    removed = _removed(docs.where("doc_id IS NOT NULL"), width, percent).hint("merge")
    out = docs.drop("n_lines", "n_kept").join(removed, F.col("doc_id") == F.col("_doc"), "left")
    breaks = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))
    out = out.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(breaks + 1))
    gone = F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed"))
    # the outer transform binds the split text once
    numbers = "array_except(sequence(0, size(ls) - 1), _removed)"
    rest = rf"get(transform(array(split(text, '\n', -1)), ls -> array_join(transform({numbers}, i -> get(ls, i)), '\n')), 0)"
    kept = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.expr(rest))
    return out.withColumn("n_kept", F.col("n_lines") - gone).withColumn("text", kept).drop("_doc", "_removed")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_kept", "text")
