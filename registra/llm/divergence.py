"""How sources differ in their words: smoothed shares of terms, compared between sources of a language.

A pair of sources starts at V times the difference that two counts of zero make. An inverted index corrects it: terms
that only one of the two holds count alike for equal counts, so each source's terms are corrected together by their
count; terms that both hold meet in the postings. Only corrections other than zero are emitted. All numbers are whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .url_filters import LOWER, UPPER

#: Between terms: ASCII but letters.
APART = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, LEAST_DOCS, TOP = 1_000_000_000, 10, 10


def _share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), in decimals: counts of any table are exact."""
    whole = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    above, below = (whole(count) + 2) * F.lit(SCALE).cast("decimal(10,0)"), whole(total) + 2 * whole(terms)
    return 1 + F.call_function("div", above, below)


def _apart(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2^30, so 64 bits hold it all."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def _postings(docs: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the terms in at least ``least`` documents of a language: occurrences in
    the source and in the language; ``first`` marks one source of each term."""
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), APART, -1), lambda w: w != "")
    # each occurrence, and each term once more for the document
    told = docs.select("lang", "source", words.alias("words"))
    told = told.select("lang", "source", F.explode(F.array(
        F.struct(F.lit(1).alias("n"), F.lit(0).alias("docs"), F.col("words")), F.struct(F.lit(0).alias("n"), F.lit(1).alias("docs"), F.array_distinct("words").alias("words"))
    )).alias("t"))
    told = told.select("lang", "source", "t.n", "t.docs", F.explode("t.words").alias("term"))
    counts = told.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = W.partitionBy("lang", "term")
    rows = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(whole).alias("lang_n"), F.sum("docs").over(whole).alias("lang_docs"),
        (F.row_number().over(whole.orderBy("source")) == 1).alias("first"),
    )
    return rows.where(F.col("lang_docs") >= least).drop("lang_docs")


def _groups(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, zero): each group with the occurrences of kept terms in it and in its
    language, how many terms are kept, and the share of a count of zero (NULL if none are)."""
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("first"))
    known = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").fillna(0, ["total", "first"])
    langs = own.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("first").alias("terms"))
    rows = known.drop("first").join(langs, "lang", "left").fillna(0, ["lang_total", "terms"])
    return rows.withColumn("zero", F.when(F.col("terms") > 0, _share(F.lit(0), "total", "terms")))


def _pair_values(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, in both directions."""
    a = groups.select("lang", "source", "terms", "total", F.col("zero").alias("zero"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"))
    started = a.join(b, "lang").where("source != item")
    start = started.select("lang", "source", "item", F.coalesce(F.col("terms") * _apart("zero", "item_zero"), F.lit(0)).alias("value"))

    # one side: what a term of that count adds if the other source lacks it
    alike = postings.groupBy("lang", "source", "n").agg(F.count("*").alias("alike"))
    alike = alike.join(a, ["lang", "source"]).withColumn("share", _share("n", "total", "terms"))
    one = alike.join(b, "lang").where("source != item")
    one = one.select("lang", "source", "item", (F.col("alike") * (_apart("share", "item_zero") - _apart("zero", "item_zero"))).alias("value")).where("value != 0")
    # both sides: what the term adds beside its two one-sided corrections
    shared = postings.join(a, ["lang", "source"]).select("lang", "term", "source", _share("n", "total", "terms").alias("share"), "zero")
    other = shared.select("lang", "term", F.col("source").alias("item"), F.col("share").alias("item_share"), F.col("zero").alias("item_zero"))
    met = shared.join(other, ["lang", "term"]).where("source < item")
    more = _apart("share", "item_share") - _apart("share", "item_zero") - _apart("zero", "item_share") + _apart("zero", "item_zero")
    both = met.select("lang", "source", "item", more.alias("value")).where("value != 0")

    half = one.unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    half = common.materialize(half, "corrections")
    turned = half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return start.unionByName(half).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


@common.written("divergence")
def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and by what.

    Null texts, languages and sources are ''. Terms are runs of letters and of characters beyond ASCII, A-Z
    lower-cased; a language keeps those in at least ``least`` of its documents. A group's share of a term is
    1 + floor(10^9 * (count + 2) / (N + 2 V)), N being its occurrences of the V kept terms; groups without any take
    part. ``pair`` rows sum floor((p - q)^2 / (p + q)) over all kept terms for each other source (0 without terms);
    ``term`` rows tell it of the terms that a group has and uses more than its language, the ``top`` highest. Ranks go
    by value, highest first, then by the item's bytes. Repeated rows count each; other columns are ignored; an empty
    table gives an empty result, a language's only source no pairs.
    """
    docs = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    postings = common.materialize(_postings(docs, least), "postings")
    groups = common.materialize(_groups(docs, postings), "groups")
    terms = postings.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "total", "terms"), "q": _share("lang_n", "lang_total", "terms")})
    terms = terms.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart("p", "q").alias("value"))
    pairs = _pair_values(postings, groups).withColumn("part", F.lit("pair"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(pairs.withColumn("rank", F.row_number().over(order))).select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"))
