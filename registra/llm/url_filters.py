"""URL filters by a sort-merge range join over reversed-host keys. Only DataFrame functions.

A rule's key is its host, labels reversed, and its path; the keys that begin with it are an interval. A URL is a point
for each domain that its host belongs to, so a rule fits if its interval holds one of the URL's points. Intervals nest
or are apart. Points, starts and ends of intervals are sorted together, and a sweep keeps the stack of open rules: the
running sum of +1 for a start and -1 for an end is the stack's height, and the last start that reached this height is
the rule on top. Sorted rows lie in ranges of bounded size, whatever keys they have; each range begins by pushing the
rules that are open where it starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The verdict on a URL that no rule fits.
DEFAULT = "allow"
#: Order at equal keys: rules pushed at the beginning of a range, starts, points; ends have keys of their own.
PUSH, START, POINT, END = 0, 1, 2, 3
#: Rows of a range: as few as make four ranges for each shuffle partition, and at most the second number.
FEW_ROWS, MOST_ROWS = 4096, 1 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (then up to ``?``,
    ``#`` or the end) of a URL; both are empty for NULL and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def _key(labels: Column, path: Column) -> Column:
    """Sortable bytes of a domain's reversed labels and a path; a host holds no slash, so the first one parts them."""
    return F.encode(F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path), "UTF-8")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _keyed(rules: DataFrame) -> DataFrame:
    """(key, labels, rule struct) of each different rule; of several verdicts on one, the last by alphabet counts."""
    host = F.translate(F.regexp_extract("rule", r"^[^/]*", 0), UPPER, LOWER)
    path = F.substr(F.col("rule"), F.length(host) + 1)
    # longer rules win, then longer hosts
    value = F.struct(F.length("rule").alias("size"), F.length(host).alias("host_size"), "rule", "verdict")
    rows = rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select(_key(_labels(host), path).alias("key"), F.size(_labels(host)).alias("labels"), value.alias("rule"))
    return rows.groupBy("key").agg(F.max("labels").alias("labels"), F.max_by("rule", F.struct("rule.verdict", "rule.rule")).alias("rule"))


_ORDER = ("key", "kind", "row")


def _sorted_ranges(events: DataFrame, n: int) -> DataFrame:
    """``events`` with ``range``: numbers of ``n`` ranges in their order. Points of equal keys part by their row."""
    dealt = events.repartitionByRange(n, *_ORDER).withColumn("range", F.spark_partition_id())
    return common.materialize(dealt, "ranges")


def _pushes(dealt: DataFrame) -> DataFrame:
    """Rows that push, at the beginning of each range, the rules that earlier ranges leave open, outermost first.

    From the rules' rows, and one row for each range: how many rules are open at its beginning, and for each height
    of the stack the last rule that reached it before.
    """
    totals = dealt.groupBy("range").agg(F.sum("delta").alias("total"))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    opened = common.materialize(totals.select("range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("open")), "open")
    along = W.partitionBy("range").orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, 0)
    rules = dealt.where(F.col("kind") != POINT).select("*", F.sum("delta").over(along).alias("local")).where(F.col("kind") == START)
    reached = rules.join(opened, "range").groupBy("range", (F.col("open") + F.col("local")).alias("height")).agg(F.max_by("rule", "key").alias("rule"))
    wanted = opened.where("open > 0").select("range", F.explode(F.sequence(F.lit(1).cast("long"), "open")).alias("height"))
    both = reached.withColumn("wanted", F.lit(False)).unionByName(wanted.withColumn("wanted", F.lit(True)), allowMissingColumns=True)
    before = W.partitionBy("height").orderBy("range", F.desc("wanted")).rowsBetween(W.unboundedPreceding, -1)
    found = both.select("range", "height", "wanted", F.last("rule", ignorenulls=True).over(before).alias("rule")).where("wanted")
    return found.select(
        F.lit(b"").alias("key"), F.lit(PUSH).alias("kind"), F.col("height").alias("row"), F.lit(1).alias("delta"), "rule", "range"
    )


def fitting(points: DataFrame, rules: DataFrame, n: int) -> DataFrame:
    """(row, rule): for each point (key, row) the longest rule whose key its own begins with, if there is one."""
    none, zero = F.lit(None), F.lit(0).cast("long")
    shape = lambda df, key, kind, row, delta, rule: df.select(key.alias("key"), F.lit(kind).alias("kind"), row.alias("row"), F.lit(delta).alias("delta"), rule.alias("rule"))
    rule = rules.schema["rule"].dataType
    events = shape(points, F.col("key"), POINT, F.col("row"), 0, none.cast(rule))
    events = events.unionByName(shape(rules, F.col("key"), START, zero, 1, F.col("rule")))
    # 0xFF is no byte of UTF-8: this end follows all keys that begin with the rule's
    events = events.unionByName(shape(rules, F.concat("key", F.lit(b"\xff")), END, zero, -1, none.cast(rule)))
    dealt = _sorted_ranges(events, n)
    rows = dealt.unionByName(_pushes(dealt))
    along = W.partitionBy("range").orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, 0)
    swept = rows.withColumn("height", F.sum("delta").over(along))
    slot = W.partitionBy("range", "height").orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, 0)
    return swept.withColumn("top", F.last("rule", ignorenulls=True).over(slot)).where((F.col("kind") == POINT) & (F.col("height") > 0)).select("row", F.col("top").alias("rule"))


@common.written("verdicts")
def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, keep: Sequence[str] = ("page_id",), ranges: int | None = None) -> DataFrame:
    """``keep`` columns of each page, its URL's host and path, the rule that decides and its verdict.

    ``rules`` has ``rule`` (a host, then from the first slash on a path) and ``verdict``. A rule fits its host and all
    subdomains if the path begins with the rule's; of several the longest decides, of equally long ones that of the
    longer host. Where none fits, the rule is NULL and the verdict ``default``. NULL URLs, and those without ``://``,
    have an empty host and path. Repeated rows are judged each; of rules with equal host and path the verdict last by
    alphabet counts, and rules with a NULL are left out. Other columns are ignored, so names can't clash; empty tables
    give empty results, and without rules all get the default. URLs and hosts may be of any length: only as many
    labels and bytes of a key are compared as the longest rule has.
    """
    host, path = host_and_path(F.col("url"))
    base = common.materialize(pages.select(*keep, host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")), "urls")
    keyed = common.materialize(_keyed(rules), "rules")
    most = keyed.agg(F.max("labels").alias("labels"), F.max(F.octet_length("key")).alias("bytes"), F.count("*").alias("n")).first()
    if not most.n:
        return base.drop("row").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = _labels(F.col("host"))
    points = base.select("row", "path", labels.alias("labels"), F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most.labels)))).alias("depth"))
    domain = F.slice("labels", -F.col("depth"), F.col("depth"))
    points = points.select("row", F.substring(_key(domain, F.col("path")), 1, most.bytes).alias("key"))
    if ranges is None:
        rows, partitions = base.count() * most.labels + 2 * most.n, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(1, min(4 * partitions, -(-rows // FEW_ROWS)), -(-rows // MOST_ROWS))
    best = fitting(points, keyed, ranges).groupBy("row").agg(F.max("rule").alias("_best"))
    out = base.join(best, "row", "left")
    return out.select(*keep, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")) for rule, verdict in RULES])
    return judge(common.table(spark, sf_dir, "pages"), spark.range(1).select(F.inline(rules)))
