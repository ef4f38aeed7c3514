"""Helpers shared by the text operators: tables, shared storage, words and components."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, as in tests, one machine's temporary folder stands in, but never on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share: working tables go there")
    return _own.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="registra-"))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _shuffles_end_with_query(spark: SparkSession):
    """Within, Spark removes a query's shuffle files as soon as its result is written."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def _no_broadcasts(spark: SparkSession):
    """Within, joins shuffle both sides at every size: what is sent then grows with the input, not where a side
    outgrows the broadcasts."""
    return _setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1")


def small_batches(spark: SparkSession, rows: int = 512):
    """Within, tasks pass so many rows to Python at once, and as many back: whole texts and their ids are wide."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


_working: ContextVar[list | None] = ContextVar("working", default=None)


def materialize(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder, parted ``by`` columns, and read it again: cuts the lineage and survives lost
    executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/registra/{label}-{uuid.uuid4().hex}"
    with _shuffles_end_with_query(spark):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    if (tables := _working.get()) is not None:
        tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """As materialize(), dealt into Spark's buckets by ``key``, one for each shuffle partition: joins and groups by that
    key shuffle none of the table's rows any more, and what joins it is shuffled to it at every size."""
    spark = df.sparkSession
    name = f"registra_{uuid.uuid4().hex}"
    path, buckets = f"{shared_dir(spark)}/registra/{label}-{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shuffles_end_with_query(spark):
        df.repartition(buckets, key).write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    if (tables := _working.get()) is not None:
        tables.append(path)
    out = spark.table(name)
    # the plan knows the files and how they are dealt; the catalog need not keep the name
    spark.sql(f"DROP TABLE {name}")
    return out


def discard(df: DataFrame) -> None:
    """Remove tables made by materialize() that ``df`` reads and no later plan does."""
    for path in {m.group() for f in df.inputFiles() if (m := re.match(r".*/registra/[^/]+", f))}:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(label: str, broadcasts: bool = True):
    """A function's DataFrame as a table; the working tables that were made on the way are removed. ``broadcasts`` tells
    whether small sides of joins may be broadcast on the way."""

    def wrap(f):
        @wraps(f)
        def call(*args, **kwargs):
            own, outer = [], _working.get()
            _working.set(own)
            try:
                with nullcontext() if broadcasts else _no_broadcasts(SparkSession.active()):
                    df = f(*args, **kwargs)
                    _working.set(outer)
                    return materialize(df, label)
            finally:
                _working.set(outer)
                for path in own:
                    _delete(SparkSession.active(), path)

        return call

    return wrap


def by_row(rows: DataFrame, run, schema: str) -> DataFrame:
    """``rows``.mapInPandas(run, schema), where ``doc_id`` (a long) passes as text, and back: with a null among them
    pandas would make floats of whole numbers, and round ids of 64 bits."""
    as_text = rows.withColumn("doc_id", F.col("doc_id").cast("long").cast("string"))
    out = as_text.mapInPandas(run, schema.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case; none for a null text."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Distributed union-find by alternating large and small stars.

    ``edges`` holds undirected links in columns ``a`` and ``b`` (loops and repeats are fine). Returns one row
    ``(id, component)`` for each node that has a link to another; ``component`` is the smallest node reachable.
    Each round is joins and minima, written to the shared folder; only a count and a checksum reach the driver.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    now = materialize(edges.where(F.col(a) != F.col(b)).select(low.alias("u"), high.alias("v")).distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = joined.where("u != m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        small = small.unionByName(least.select(F.col("m").alias("u"), "v")).distinct()
        following = materialize(small, "edges")
        discard(large)
        discard(now)
        now, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    stars = now.select(F.col("v").alias("id"), F.col("u").alias("component"))
    roots = now.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return stars.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(h), F.bit_xor(F.xxhash64(h, F.lit(1)))).first()
    return tuple(row)


def components_by_bands(items: DataFrame, confirm, settle) -> DataFrame:
    """(id, component) of items that are linked to another one; see connected_components().

    ``items`` has ``id`` and ``bands`` (array of keys); links are sought between items that share one. ``confirm(pairs)``
    tells of pairs (a, b), as ``link``, whether they are linked, and as ``d`` how far apart they are, or NULL; pairs
    that it leaves out are not linked.

    In each bucket every item is first compared with the smallest id only, and confirmed links join components. Of the
    buckets that hold several components all the same, ``settle(rows)`` gets the rows (band, a, id, component, d), a
    being the smallest id and d the distance to it, and returns further links (a, b) across components. So a group
    of n similar items costs about n comparisons, not n * n, wherever they are linked to one of them.
    """
    banded = items.select("id", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("band", "a")
    least = materialize(least, "least")
    shared = materialize(banded.join(least, "band"), "shared")
    discard(least)
    first = materialize(shared.where("id != a").select("a", F.col("id").alias("b")).distinct(), "pairs")
    tested = materialize(confirm(first).select("a", "b", "link", "d"), "tested")
    discard(first)
    links = tested.where("link").select("a", "b")

    labels = connected_components(links)
    unsettled = unsettled_buckets(shared, labels)
    unsettled = unsettled.join(tested.select("a", F.col("b").alias("id"), "d"), ["a", "id"], "left")
    unsettled = unsettled.withColumn("d", F.when(F.col("id") == F.col("a"), 0.0).otherwise(F.col("d")))
    unsettled = materialize(unsettled.select("band", "a", "id", "component", "d"), "unsettled")
    discard(shared)
    more = materialize(settle(unsettled), "links")
    labels = labels if more.isEmpty() else connected_components(links.unionByName(more))
    for used in (unsettled, tested, more):
        discard(used)
    return labels


def unsettled_buckets(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (band, id, ...) of the bands that hold several components, with ``component`` by ``labels``."""
    labelled = rows.drop("component").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return labelled.join(split.where("low < high").select("band"), "band")
