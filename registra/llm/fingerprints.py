"""Document fingerprints: a multiset hash that adds up wide vectors of paragraphs, each lane modulo a power of two.

Only DataFrame functions. A document's paragraphs are its lines. A paragraph's vector has eight exact lanes, 32 bits
each, hashed from the whole paragraph, and 128 signed lanes, which add up +1 or -1 for each of its stretches of 48
characters. Vectors of documents are sums over paragraphs: their order does not matter, and paragraphs can be added
to or taken from a stored fingerprint without the rest of the text. Equal multisets have equal fingerprints; exact
lanes tell different ones apart, and squared distances of the signed lanes estimate how much two texts share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

EXACT, SIGNED, STRETCH, MASK = 8, 128, 48, (1 << 32) - 1
#: Ranges that one set of quantiles makes; beyond, each of them is parted again.
MOST_RANGES = 4096


def paragraphs(text: Column) -> Column:
    """Lines of a text; a null text is the empty text, of one empty paragraph."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lanes() -> list[Column]:
    """Sums over rows (paragraph, stretch, lead): lead marks a paragraph's first stretch."""
    out, low = [], F.lit(MASK)
    for i in range(EXACT // 2):
        h = F.when(F.col("lead"), F.xxhash64("paragraph", F.lit(i + 1)))
        out += [F.sum(h.bitwiseAND(low)).alias(f"e{2 * i}"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"e{2 * i + 1}")]
    for j in range(SIGNED):
        bit = F.shiftrightunsigned(F.col(f"h{j // 64}"), j % 64).bitwiseAND(F.lit(1))
        out.append(F.sum(F.col("weight") * (2 * bit - 1)).alias(f"s{j}"))
    return out


def add_vectors(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """For each distinct row of ``keys``, ``exact`` and ``signed``: the sum of its paragraphs' vectors.

    ``keys`` tell rows apart and agree with how ``rows`` is dealt out, so that nothing is shuffled here.
    """
    lines = rows.select(*keys, F.explode(paragraphs(F.col(text))).alias("paragraph"))
    # code points, not bytes: stretches are cut from a fixed-width encoding in constant time each
    lines = lines.withColumn("wide", F.encode("paragraph", "UTF-16BE"))
    lines = lines.withColumn("last", F.expr(f"greatest(0, (octet_length(wide) - 1) div {2 * STRETCH})"))
    cut = lines.select(*keys, "paragraph", "wide", F.explode(F.expr("sequence(0L, cast(last as bigint))")).alias("at"))
    piece = F.expr(f"substring(wide, cast(at * {2 * STRETCH} + 1 as int), {2 * STRETCH})")
    hashed = cut.select(
        *keys, "paragraph", (F.col("at") == 0).alias("lead"), F.lit(1).alias("weight"),
        *[F.xxhash64(piece, F.lit(101 + i)).alias(f"h{i}") for i in range(SIGNED // 64)],
    )
    sums = hashed.groupBy(*keys).agg(*_lanes())
    exact = F.array(*[F.col(f"e{i}").bitwiseAND(F.lit(MASK)) for i in range(EXACT)])
    return sums.select(*keys, exact.alias("exact"), _wrapped(F.array(*[F.col(f"s{j}") for j in range(SIGNED)])).alias("signed"))


def as_text(exact: Column, signed: Column) -> Column:
    """All lanes modulo 2^32, the exact ones first, as base64 of big-endian 32-bit integers."""
    digits = F.transform(F.concat(exact, signed), lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(MASK))), 8, "0"))
    return F.base64(F.unhex(F.array_join(digits, "")))


def lanes_of(fingerprint: Column) -> Column:
    """The lanes of a fingerprint, from 0 to 2^32 - 1."""
    read = F.transform(F.array(F.hex(F.unbase64(fingerprint))), lambda digits: F.transform(
        F.sequence(F.lit(0), F.lit(EXACT + SIGNED - 1)), lambda i: F.conv(F.substring(digits, 8 * i + 1, F.lit(8)), 16, 10).cast("long")
    ))
    return F.get(read, F.lit(0))


def combine(a: Column, b: Column, take_away: bool = False) -> Column:
    """The fingerprint of the paragraphs of two texts put together, or of the first's without the second's."""
    return as_text(F.zip_with(lanes_of(a), lanes_of(b), lambda x, y: x - y if take_away else x + y), F.expr("array()").cast("array<bigint>"))


def _wrapped(signed: Column) -> Column:
    """Signed lanes as fingerprints hold them: modulo 2^32, from -2^31."""
    return F.transform(signed, lambda x: (x + (1 << 31)).bitwiseAND(F.lit(MASK)) - (1 << 31))


def likeness_of(a: Column, b: Column) -> Column:
    """likeness() of the texts of two fingerprints, from these alone."""
    signed = lambda c: _wrapped(F.slice(lanes_of(c), EXACT + 1, SIGNED))
    return likeness(signed(a), signed(b))


def likeness(a: Column, b: Column) -> Column:
    """1 - |a - b|^2 / (|a|^2 + |b|^2) of the signed lanes, within 0 and 1: near 0 for texts that share nothing."""
    total = lambda xs, ys, f: F.aggregate(F.zip_with(xs, ys, f), F.lit(0.0), lambda s, x: s + x)
    apart = total(a, b, lambda x, y: ((x - y) * (x - y)).cast("double"))
    own = total(a, b, lambda x, y: (x * x + y * y).cast("double"))
    return F.when(own == 0, F.when(apart == 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / own))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each text. Null texts count as empty; repeated rows give repeated results; rows
    without a doc_id keep a null one; other columns are ignored; an empty table gives an empty result."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return add_vectors(rows, ["doc_id", "row"], "text").select("doc_id", as_text(F.col("exact"), F.col("signed")).alias("fingerprint"))


def _range(key: str, cuts: str) -> Column:
    """Number of the sorted ``cuts`` below ``key``, by halving."""
    steps = ", ".join(str(1 << i) for i in reversed(range(MOST_RANGES.bit_length())))
    return F.expr(f"aggregate(array({steps}), 0, (at, step) -> if(coalesce(get({cuts}, at + step - 1) < {key}, false), at + step, at))")


def _dealt(rows: DataFrame, key: str, size: int) -> DataFrame:
    """``rows`` with column ``bucket``: ranges of ``key`` that hold about ``size`` rows each, whatever its values.

    Quantiles bound the ranges, at most 4,096 of all rows, and where more are wanted as many of each such range. They
    are written down, so that every plan that reads them deals alike. Equal keys share a range.
    """
    wanted = max(1, -(-rows.count() // size))

    def quantiles(n: int) -> Column:
        return F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 100 * MOST_RANGES)

    cuts = rows.agg(quantiles(min(wanted, MOST_RANGES)).alias("cuts")).withColumn("one", F.lit(0))
    cuts = common.materialize(cuts, "cuts")
    dealt = rows.withColumn("one", F.lit(0)).join(F.broadcast(cuts), "one").withColumn("bucket", _range(key, "cuts").cast("long")).drop("one", "cuts")
    if wanted > MOST_RANGES:
        finer = dealt.groupBy("bucket").agg(quantiles(min(MOST_RANGES, -(-wanted // MOST_RANGES))).alias("cuts"))
        dealt = dealt.join(F.broadcast(common.materialize(finer, "cuts")), "bucket")
        dealt = dealt.withColumn("bucket", F.col("bucket") * MOST_RANGES + _range(key, "cuts")).drop("cuts")
    return dealt


def following(ids: DataFrame, size: int = 1024) -> DataFrame:
    """(doc_id, next_id) for distinct ids, none null, in descending order; the last is followed by the first, and a
    single id by itself. An empty table gives an empty result.

    Within ranges of ids by a window, across ranges by the same on one id for each range.
    """
    if ids.count() <= 4 * size:
        down = W.orderBy(F.desc("doc_id"))
        first = ids.agg(F.max("doc_id").alias("top"))
        led = ids.select("doc_id", F.lead("doc_id").over(down).alias("next_id"), F.lit(0).alias("one"))
        led = led.join(F.broadcast(first.withColumn("one", F.lit(0))), "one")
        return led.select("doc_id", F.coalesce("next_id", "top").alias("next_id"))
    dealt = _dealt(ids, "doc_id", size)
    tops = common.materialize(dealt.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).select("doc_id", "bucket"), "tops")
    across = following(tops.select("doc_id"), size).join(tops, "doc_id").select("bucket", F.col("next_id").alias("across"))
    down = W.partitionBy("bucket").orderBy(F.desc("doc_id"))
    inside = dealt.select("doc_id", "bucket", F.lead("doc_id").over(down).alias("inside"))
    return inside.join(across, "bucket").select("doc_id", F.coalesce("inside", "across").alias("next_id"))


def with_next_text(docs: DataFrame, size: int = 128) -> DataFrame:
    """Each row with the text of the next document in descending order of doc_id, dealt out by ``bucket``.

    Rows are shuffled once, by ranges of ids. Each range also gets, marked ``end``, the row that follows its last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = _dealt(rows, "doc_id", size)
    tops = common.materialize(dealt.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")), "tops")
    after = following(tops.select("doc_id")).join(tops, "doc_id").select("bucket", F.col("next_id").alias("doc_id"))
    after = common.materialize(after, "after")
    ends = rows.join(after, "doc_id").groupBy("bucket").agg(F.min("text").alias("text"))
    every = dealt.select("bucket", "doc_id", "text", F.lit(False).alias("end")).unionByName(
        ends.select("bucket", F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("end"))
    )
    down = W.partitionBy("bucket").orderBy("end", F.desc_nulls_last("doc_id"), "text")
    return every.select("*", F.coalesce(F.lead("text").over(down), F.lit("")).alias("next_text"), F.row_number().over(down).alias("place"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they are to it and to the next document's.

    The edit replaces the last floor(n_chars / 2) code points by the first as many (or all) of the next document
    in descending order of doc_id; the last is followed by the first. Null texts count as empty. Rows that share a
    doc_id follow each other in order of their texts. A single row follows itself. Rows without a doc_id have no
    place in that order and are left out. Other columns are ignored; an empty table gives an empty result.
    """
    rows = with_next_text(docs.where("doc_id IS NOT NULL")).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("t")) for k, t in enumerate((F.col("text"), edited))]))
    keys = ["bucket", "place", "kind", "doc_id", "end", "n_chars", "sha256"]
    both = rows.select("bucket", "place", "doc_id", "end", "n_chars", kinds.alias("v"))
    both = both.select("*", F.col("v.kind").alias("kind"), F.col("v.t").alias("t"))
    both = both.withColumn("sha256", F.when(F.col("kind") == 1, F.sha2(F.col("t").cast("binary"), 256)))
    sums = add_vectors(both, keys, "t")
    along = W.partitionBy("bucket").orderBy("place", "kind")
    later = lambda c, k: F.lead(c, k).over(along)
    side = sums.select(
        *keys, "exact", "signed", later("exact", 1).alias("exact_edit"), later("signed", 1).alias("signed_edit"),
        later("sha256", 1).alias("edited_sha256"), later("signed", 2).alias("signed_next"),
    ).where("kind = 0 AND NOT end")
    return side.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("exact"), F.col("signed")).alias("fingerprint"),
        as_text(F.col("exact_edit"), F.col("signed_edit")).alias("edited_fingerprint"),
        likeness(F.col("signed"), F.col("signed_edit")).alias("near_edited"),
        likeness(F.col("signed"), F.col("signed_next")).alias("near_next"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.table(spark, sf_dir, "documents"))
