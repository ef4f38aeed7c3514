"""Panels and series over dated snapshots: targets, as-of dates, entry and exit marks, aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import is_true, parse_period

_STEP = {"year": ("year", 12), "quarter": ("quarter", 3), "month": ("month", 1)}
_GAP_DAYS = {"year": 365, "quarter": 92, "month": 31}


@dataclass(frozen=True)
class TimeMeta:
    """What a DataFrame can't carry along: index, keys and frequency of a panel or series."""

    index: str
    keys: tuple[str, ...]
    frequency: str


def period_targets(spark: SparkSession, start: str, end: str, frequency: str) -> DataFrame:
    """(target_date) ends of the periods that cover start to end (E2); the last may lie after ``end``."""
    unit, months = _STEP[frequency]
    days = spark.range(1).select(F.explode(F.expr(f"sequence(trunc(DATE'{start}', '{unit}'), trunc(DATE'{end}', '{unit}'), INTERVAL {months} MONTH)")).alias("first"))
    return days.select(F.last_day(F.add_months("first", months - 1)).alias("target_date"))


def locf(targets: DataFrame, available: DataFrame, max_gap_days: int | None = None) -> DataFrame:
    """(target_date, snapshot_date, period): the latest snapshot at or before each target.

    Targets before the first snapshot are left out, as are those whose snapshot lies more than ``max_gap_days``
    back. Both sides are merged and carried forward in order, so many dates cost a sort and no product.
    """
    merged = available.select(F.col("snapshot_date").alias("at"), F.lit(0).alias("kind"), F.col("snapshot_date").alias("seen")).unionByName(
        targets.select(F.col("target_date").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("date").alias("seen"))
    )
    carried = merged.withColumn("snapshot_date", F.last("seen", ignorenulls=True).over(W.orderBy("at", "kind")))
    out = carried.where("kind = 1 AND snapshot_date IS NOT NULL").select(F.col("at").alias("target_date"), "snapshot_date").distinct()
    if max_gap_days is not None:
        out = out.where(F.datediff("target_date", "snapshot_date") <= max_gap_days)
    return out.withColumn("period", F.col("target_date").cast("string"))


def gap_days(max_gap: float, frequency: str) -> int:
    """A gap in periods as days."""
    return int(max_gap * _GAP_DAYS[frequency])


def entry_exit(panel: DataFrame, key: str = "org_nr", bankrupt: str = "bankrupt") -> DataFrame:
    """Marks of each key's first and last period (W1); a bankrupt one exits whenever it is so."""
    w = W.partitionBy(key)
    last = F.col("period") == F.max("period").over(w)
    if bankrupt in panel.columns:
        last = last | is_true(bankrupt)
    return panel.withColumn("is_entry", F.col("period") == F.min("period").over(w)).withColumn("is_exit", last)


def panel(snapshots: DataFrame, mapping: DataFrame, columns: Sequence[str], key: str = "org_nr") -> DataFrame:
    """key x period with the values of the snapshot that each period maps to.

    The mapping has one row for each period, so it is broadcast, and only the partitions it names are read.
    """
    kept = snapshots.select(key, "snapshot_date", *[c for c in columns if c not in (key, "snapshot_date")])
    return entry_exit(kept.join(F.broadcast(mapping), "snapshot_date"), key)


AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "total": lambda c: F.coalesce(F.sum(c), F.lit(0)), "mean": F.avg, "sd": F.stddev_samp, "median": F.median, "min": F.min, "max": F.max,
    "n_distinct": F.count_distinct, "mean_strict": lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.avg(c)),
}


def series(
    snapshots: DataFrame, mapping: DataFrame, values: Sequence[str] = (),
    functions: Sequence[str] | dict = ("total",), by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates for each period and group (A1): rows if no ``values``, else every value by every function.

    Functions are names in AGGREGATES, or a mapping from names to functions of a Column (or grouped pandas UDFs).
    A snapshot that serves several periods is read once.
    """
    chosen = functions if isinstance(functions, dict) else {f: AGGREGATES[f] for f in functions}
    rows = snapshots.select("snapshot_date", *dict.fromkeys([*by, *values])).join(F.broadcast(mapping.select("snapshot_date", "period")), "snapshot_date")
    out = [f(F.col(v)).alias(f"{v}_{name}") for v in values for name, f in chosen.items()] or [F.count("*").alias("n")]
    return rows.groupBy("period", *by).agg(*out)


def to_time_series(
    df: DataFrame, keys: Sequence[str] = ("org_nr",), index: str | None = None, frequency: str = "irregular"
) -> tuple[DataFrame, TimeMeta]:
    """``df`` with its index as a date, sorted within keys, and its description (E5); fails if key and index repeat."""
    index = index or ("snapshot_date" if "snapshot_date" in df.columns else "period")
    out = df.withColumn(index, parse_period(index))
    if not out.groupBy(*keys, index).count().where("count > 1").isEmpty():
        raise ValueError(f"{index} is not unique within {', '.join(keys)}")
    return out.orderBy(*keys, index), TimeMeta(index, tuple(keys), frequency)
