"""Schema drift: which fields entities fill, by segment and period, and what came or went."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lifecycle(bankrupt: str = "bankrupt", forced: str = "forced_dissolution", liquidation: str = "in_liquidation") -> Column:
    """konkurs before tvangsavvikling before avvikling before ordinary, as the source names them."""
    true = lambda c: F.col(c).eqNullSafe(F.lit(True))
    return F.when(true(bankrupt), "konkurs").when(true(forced), "tvangsavvikling").when(true(liquidation), "avvikling").otherwise("ordinary")


def segment(form: str = "legal_form", state: Column | None = None) -> Column:
    return F.concat_ws("|", F.coalesce(F.col(form), F.lit("UKJENT")), state if state is not None else lifecycle())


def leaf_paths(kind: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, type) of the leaves of a schema; array items are written [], links are left out."""
    if isinstance(kind, T.StructType):
        return [x for f in kind if not f.name.endswith("_links") for x in leaf_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType):
        return leaf_paths(kind.elementType, f"{path}[]")
    return [(path, kind.simpleString())]


def _filled(path: str) -> Column:
    """Whether an entity has a value at a leaf; below an array, in any of its items."""
    head, dot, rest = path.partition("[]")
    if not dot:
        return F.col(head).isNotNull()

    def inside(item: Column, rest: str) -> Column:
        step, more, below = rest.removeprefix(".").partition("[]")
        for part in step.split(".") if step else []:
            item = item.getField(part)
        return F.exists(item, lambda x: inside(x, below)) if more else item.isNotNull()

    return F.coalesce(F.exists(F.col(head), lambda x: inside(x, rest)), F.lit(False))


def prevalence(entities: DataFrame, segment_column: str, paths: list[tuple[str, str]] | None = None) -> DataFrame:
    """(segment, path, type, k, n): entities that fill each path, of those in the segment (A10).

    One aggregation with a count for each leaf of the schema, then one row for each path that occurs.
    """
    paths = paths or [p for p in leaf_paths(entities.schema) if p[0] != segment_column]
    counts = entities.groupBy(F.col(segment_column).alias("segment")).agg(F.count("*").alias("n"), *[F.count_if(_filled(p)).alias(f"k{i}") for i, (p, _) in enumerate(paths)])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(t).alias("type"), F.col(f"k{i}").alias("k")) for i, (p, t) in enumerate(paths)])
    return counts.select("segment", "n", F.explode(rows).alias("_r")).select("segment", "_r.path", "_r.type", "_r.k", "n").where("k > 0")


def theta(k: str = "k", n: str = "n") -> Column:
    """Posterior mean of a share under Jeffreys' prior."""
    return (F.col(k) + 0.5) / (F.col(n) + 1)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x > 0: Stirling's series eight steps further up."""
    z = x + 8
    below = x
    for i in range(1, 8):
        below = below * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _let(value: Column, then) -> Column:
    """``then(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _beta_share(x: Column, a: Column, b: Column, front: Column, steps: Column) -> Column:
    """The beta distribution's share below x: the incomplete beta function's continued fraction of ``steps`` terms."""

    def share(v: Column) -> Column:
        u, s, t = v["u"], v["s"], v["t"]

        def term(f: Column, j: Column) -> Column:
            m = F.floor(j / 2)
            even, odd = m * (t - m) / ((s + 2 * m - 1) * (s + 2 * m)), -(s + m) * (s + t + m) / ((s + 2 * m) * (s + 2 * m + 1))
            return 1 + F.when(j % 2 == 0, even).otherwise(odd) * u / f

        part = F.exp(front + s * F.log(u) + t * F.log1p(-u)) / s / F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(1.0), term)
        return F.when(v["upper"], 1 - part).otherwise(part)

    upper = x > (a + 1) / (a + b + 2)
    swap = lambda one, two: F.when(upper, two).otherwise(one)
    return _let(F.struct(upper.alias("upper"), swap(x, 1 - x).alias("u"), swap(a, b).alias("s"), swap(b, a).alias("t")), share)


def beta_quantile(p: float, a: Column, b: Column) -> Column:
    """Quantile of the beta distribution by 50 bisections; no Python. Terms of the fraction grow with the root of a + b."""

    def found(c: Column) -> Column:
        def halve(at: Column, _: Column) -> Column:
            middle = (at["low"] + at["high"]) / 2
            less = _beta_share(middle, c["a"], c["b"], c["front"], c["steps"]) < p
            return _let(F.struct(less.alias("less"), middle.alias("m"), at.alias("at")), lambda v: F.struct(
                F.when(v["less"], v["m"]).otherwise(v["at"]["low"]).alias("low"), F.when(v["less"], v["at"]["high"]).otherwise(v["m"]).alias("high")))

        whole = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(50)), whole, halve, lambda at: (at["low"] + at["high"]) / 2)

    front = _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
    steps = (60 + 4 * F.sqrt(a + b)).cast("int")
    return F.when(front.isNotNull(), _let(F.struct(a.alias("a"), b.alias("b"), front.alias("front"), steps.alias("steps")), found))


def with_interval(rows: DataFrame, level: float = 0.95) -> DataFrame:
    """``rows`` with theta, theta_low and theta_high: Jeffreys' interval for k of n."""
    tail = (1 - level) / 2
    a, b = F.col("k") + F.lit(0.5), F.col("n") - F.col("k") + F.lit(0.5)
    return rows.withColumns({"theta": theta(), "theta_low": beta_quantile(tail, a, b), "theta_high": beta_quantile(1 - tail, a, b)})


def top_segment(rows: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """The segment that fills each path most."""
    w = W.partitionBy(*keys).orderBy(F.desc(theta()), "segment")
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def concentration(rows: DataFrame) -> DataFrame:
    """(path, segment, theta, theta_marg, concentration): the segment that drives each path, against all segments.

    ``rows`` are prevalence() rows of a period, or cumulated ones; segments are counted once each.
    """
    total = rows.select("segment", "n").distinct().agg(F.sum("n").alias("_all"))
    marginal = rows.groupBy("path").agg(F.sum("k").alias("_k")).withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
    marginal = marginal.select("path", (F.col("_k") / F.col("_all")).alias("theta_marg"))
    found = top_segment(rows).withColumn("theta", theta()).join(marginal, "path")
    return found.select("path", "segment", "theta", "theta_marg", (F.col("theta") - F.col("theta_marg")).alias("concentration"))


def coverage(rows: DataFrame) -> DataFrame:
    """(segment, n, n_fields): how many fields each segment is seen to fill."""
    return rows.groupBy("segment").agg(F.max("n").alias("n"), F.count_if(F.col("k") > 0).alias("n_fields"))


def cumulate(before: DataFrame, now: DataFrame, period: str) -> DataFrame:
    """Field state (segment, path, type, k_cum, periods_seen, last_period) after a period."""
    fresh = now.select("segment", "path", "type", F.col("k").alias("_k"))
    out = before.join(fresh, ["segment", "path", "type"], "full_outer")
    seen = F.col("_k").isNotNull()
    return out.select(
        "segment", "path", "type", (F.coalesce("k_cum", F.lit(0)) + F.coalesce("_k", F.lit(0))).alias("k_cum"),
        (F.coalesce("periods_seen", F.lit(0)) + seen.cast("int")).alias("periods_seen"), F.when(seen, F.lit(period)).otherwise(F.col("last_period")).alias("last_period"),
    )


def drifted(before: DataFrame, now: DataFrame, expected: float = 0.8) -> DataFrame:
    """(status, segment, path): new paths with the segment that fills them most, and paths filled by ``expected`` or more before that are gone although
    their segment was seen again (D6). ``before`` and ``now`` are prevalence() rows."""
    fresh = now.join(before.select("path").distinct(), "path", "left_anti")
    most = F.row_number().over(W.partitionBy("path").orderBy(F.desc("k"), "segment"))
    new = fresh.withColumn("_rank", most).where("_rank = 1").select(F.lit("new").alias("status"), "segment", "path")
    gone = before.where(theta() >= expected).select("segment", "path").join(now.select("segment").distinct(), "segment", "left_semi")
    gone = gone.join(now.select("segment", "path"), ["segment", "path"], "left_anti")
    return new.unionByName(gone.select(F.lit("removed").alias("status"), "segment", "path"))


def stratified(events: DataFrame, bucket: str, strata: str, most: int, order: str) -> DataFrame:
    """At most ``most`` rows of each bucket and stratum, in a stated order."""
    w = W.partitionBy(bucket, strata).orderBy(order)
    return events.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= most).drop("_rank")


def source_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(kind, item, status): items of feeds that are new, and documents whose hash changed."""
    new = now.join(before, ["kind", "item"], "left_anti").select("kind", "item", F.lit("new").alias("status"))
    both = now.alias("n").join(before.alias("b"), ["kind", "item"]).where("NOT n.hash <=> b.hash")
    return new.unionByName(both.select("kind", "item", F.lit("changed").alias("status")))


def report_rows(rows: DataFrame, columns: tuple[str, ...], top: int = 12) -> DataFrame:
    """The first ``top`` rows by the last column, largest first, as a report lists them."""
    return rows.select(*columns).orderBy(F.desc(columns[-1]), *columns[:-1]).limit(top)


def report(rows: DataFrame, title: str, columns: tuple[str, ...], top: int = 12) -> str:
    """A short report in Markdown (D8, T6): the first ``top`` rows by the last column, largest first."""
    found = report_rows(rows, columns, top).collect()
    lines = [f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(str(r[c]) for c in columns) + " |" for r in found]) + "\n"


def write_tsv(rows: DataFrame, path: str) -> None:
    """Tab-separated counts."""
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
