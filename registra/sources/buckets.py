"""Snapshots in buckets of their key with a tree of digests, so that two of them meet without a shuffle.

Keys are dealt into parts, each a folder, and within a part into Spark's buckets; a snapshot lies sorted in one file
for each. A leaf of the digest tree is such a file's rows, as sums of their hashes, the next level a part, the root
the snapshot. Where digests agree nothing is read; other parts meet bucket by bucket where they lie.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bucket

PARTS, BUCKETS, PART = 32, 16, "_part"


def _digest(columns: list[str]) -> list:
    """Sums of 32-bit halves of two hashes of a row, NULLs told apart: equal multisets of rows have equal sums."""
    cells = [x for c in sorted(columns) for x in (F.lit(c), F.col(c).isNull(), F.col(c))]
    out = [F.count("*").alias("n")]
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *cells)
        out += [F.sum(h.bitwiseAND(F.lit((1 << 32) - 1))).alias(f"low{seed}"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"high{seed}")]
    return out


SUMS = ("n", "low1", "high1", "low2", "high2")


def write_bucketed(df: DataFrame, path: str, key: str = "org_nr", parts: int = PARTS, buckets: int = BUCKETS) -> None:
    """A snapshot at ``path``, one file for each part and bucket, and the leaves of its digest tree beside it.

    Two snapshots meet without a shuffle if they have the same numbers of parts and buckets. One shuffle, now.
    """
    spark, data = df.sparkSession, f"{path.rstrip('/')}/data"
    dealt = df.withColumn(PART, bucket(key, parts)).repartition(buckets, key)
    name = _table_name(data)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt.write.mode("overwrite").partitionBy(PART).bucketBy(buckets, key).sortBy(key).option("path", data).saveAsTable(name)
    leaf = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    tree = spark.table(name).groupBy(PART, leaf).agg(*_digest(df.columns))
    about = F.to_json(F.struct(F.lit(key).alias("key"), F.lit(parts).alias("parts"), F.lit(buckets).alias("buckets"), F.lit(df.schema.simpleString()[7:-1]).alias("ddl")))
    tree.withColumn("about", about).write.mode("overwrite").parquet(f"{path.rstrip('/')}/digests")


def _table_name(data: str) -> str:
    return f"registra_{hashlib.md5(data.encode()).hexdigest()}"


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A bucketed snapshot, in this session or another; Spark knows how it is dealt by a table in the session's catalog."""
    data = f"{path.rstrip('/')}/data"
    name = _table_name(data)
    if not spark.catalog.tableExists(name):
        about = tree_of(spark, path).select(F.from_json("about", "key string, parts int, buckets int, ddl string").alias("a")).select("a.*").first()
        if about is None:
            raise FileNotFoundError(f"no rows at {path}")
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in spark.read.parquet(data).schema if f.name != PART)
        where = data.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}, {PART} INT) USING parquet OPTIONS (path '{where}') PARTITIONED BY ({PART}) CLUSTERED BY ({about.key}) SORTED BY ({about.key}) INTO {about.buckets} BUCKETS")
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def tree_of(spark: SparkSession, path: str) -> DataFrame:
    """(_part, bucket, sums): the leaves."""
    return spark.read.parquet(f"{path.rstrip('/')}/digests")


def differing_parts(spark: SparkSession, old: str, new: str) -> list[int]:
    """Parts whose digests differ; none if the snapshots are the same. At most as many as there are parts."""
    up = lambda path, side: tree_of(spark, path).groupBy(PART).agg(F.struct(*[F.sum(c).alias(c) for c in SUMS]).alias(side))
    both = up(old, "old").join(up(new, "new"), PART, "full_outer")
    return sorted(r[0] for r in both.where("NOT old <=> new").select(PART).collect())


def changed_rows(spark: SparkSession, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots in the parts that differ; all others are the same in both and not read."""
    parts = differing_parts(spark, old, new)
    side = lambda path: open_bucketed(spark, path).where(F.col(PART).isin(parts)).drop(PART)
    return side(old), side(new)
