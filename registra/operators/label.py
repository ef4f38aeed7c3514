"""Code labels and concordances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .diff import first_rows


def label(df: DataFrame, tables: dict[str, DataFrame], keep_code: Sequence[str] = ()) -> DataFrame:
    """``df`` with codes replaced by labels (L1, L3, J10), column by column of ``tables`` (column -> (code, label)).

    Unknown codes and NULLs pass through. ``keep_code`` keeps the code of a column in {column}_code, before it. Code
    lists are small dimensions of a known size, so the joins are left to broadcast.
    """
    out, columns = df, list(df.columns)
    for c in [c for c in df.columns if c in tables]:
        codes = tables[c].select(F.col("code").alias("_code"), F.col("label").alias("_label")).dropDuplicates(["_code"])
        out = out.join(codes, out[c] == F.col("_code"), "left").withColumn("_new", F.coalesce("_label", F.col(c)))
        if c in keep_code:
            out = out.withColumn(f"{c}_code", F.col(c))
            columns.insert(columns.index(c), f"{c}_code")
        out = out.withColumn(c, F.col("_new")).drop("_code", "_label", "_new")
    return out.select(*columns)


def harmonize_municipality(df: DataFrame, table: DataFrame, target_date, column: str = "municipality_code") -> DataFrame:
    """{column}_harmonized and {column}_target_name at ``target_date`` (L4).

    ``table`` has source_code, target_code, target_name, valid_from, valid_to (NULL: open). A code without a
    correspondence that is valid then stays as it is, with no name.
    """
    day = F.lit(target_date).cast("date")
    valid = table.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day)))
    valid = first_rows(valid, ["source_code"], ["valid_from", "target_code"]).select("source_code", "target_code", "target_name")
    out = df.join(valid, df[column] == F.col("source_code"), "left")
    return out.select(*df.columns, F.coalesce("target_code", F.col(column)).alias(f"{column}_harmonized"), F.col("target_name").alias(f"{column}_target_name"))


def merged_codes(table: DataFrame, target_date, most: int = 50) -> DataFrame:
    """(source_code, valid_from, target_code, target_name, steps, cyclic): where each code has come to by a date (L4).

    ``table`` holds mergers: source_code became target_code (target_name) at ``valid_from``; of several on one day the
    first target counts, and mergers without a date or a code are left out. A merger is followed by its target's first
    one that is not earlier, up to ``target_date``, by a recursive query. What still goes on after ``most`` steps
    (mergers of one day that lead back) is reported as cyclic, with the code that it was last found at.
    """
    known = table.where("source_code IS NOT NULL AND target_code IS NOT NULL AND valid_from IS NOT NULL")
    known = known.where(F.col("valid_from") <= F.lit(target_date).cast("date"))
    each = first_rows(known, ["source_code", "valid_from"], ["target_code", "target_name"]).select("source_code", "valid_from", "target_code", "target_name")
    follow = each.select(F.col("source_code").alias("target_code"), F.col("valid_from").alias("then"))
    later = each.select("source_code", "valid_from", "target_code").join(follow, "target_code").where("then >= valid_from")
    later = later.groupBy("source_code", "valid_from").agg(F.min("then").alias("then"))
    step = each.join(later, ["source_code", "valid_from"], "left")
    walked = table.sparkSession.sql(
        f"""WITH RECURSIVE step AS (SELECT * FROM {{step}}), walk AS (
            SELECT source_code, valid_from, target_code, target_name, then, 1 AS steps FROM step
            UNION ALL SELECT w.source_code, w.valid_from, s.target_code, s.target_name, s.then, w.steps + 1
            FROM walk w JOIN step s ON s.source_code = w.target_code AND s.valid_from = w.then WHERE w.steps < {most})
        SELECT * FROM walk""", step=step,
    )
    end = F.max_by(F.struct("target_code", "target_name", "steps", F.col("then").isNotNull().alias("cyclic")), "steps")
    return walked.groupBy("source_code", "valid_from").agg(end.alias("end")).select("source_code", "valid_from", "end.*")


def harmonize_merged(df: DataFrame, table: DataFrame, target_date, column: str = "municipality_code", as_of: str | None = None) -> DataFrame:
    """{column}_harmonized, {column}_target_name and {column}_cyclic: codes taken through all mergers up to a date (L4).

    ``as_of`` is a column with the day at which a row's code was in use: its first merger from then on counts. Without
    it, or where it is NULL, the code's first merger does. Codes that were never merged stay, with no name.
    """
    ends = merged_codes(table, target_date)
    day = F.lit(None).cast("date") if as_of is None else F.col(as_of).cast("date")
    rows = df.withColumn("_row", F.struct(*df.columns)).select("_row", F.col(column).alias("source_code"), F.coalesce(day, F.lit("0001-01-01").cast("date")).alias("_day"))
    # a code's mergers as one small array, so that rows don't multiply
    told = ends.groupBy("source_code").agg(F.sort_array(F.collect_list(F.struct("valid_from", "target_code", "target_name", "cyclic"))).alias("_all"))
    out = rows.join(told, "source_code", "left").withColumn("_end", F.get(F.filter("_all", lambda m: m.valid_from >= F.col("_day")), F.lit(0)))
    return out.select("_row.*", F.coalesce("_end.target_code", "source_code").alias(f"{column}_harmonized"), F.col("_end.target_name").alias(f"{column}_target_name"), F.coalesce("_end.cyclic", F.lit(False)).alias(f"{column}_cyclic"))


def harmonize_nace(df: DataFrame, table: DataFrame, column: str = "nace_1", order: Sequence[str] = ("target_code",)) -> DataFrame:
    """{column}_harmonized by the first correspondence and {column}_ambiguous where there are more."""
    targets = table.select("source_code", "target_code").distinct().groupBy("source_code").agg(F.count("*").alias("targets"))
    first = first_rows(table, ["source_code"], list(order)).select("source_code", "target_code").join(targets, "source_code")
    out = df.join(first, df[column] == F.col("source_code"), "left")
    return out.select(*df.columns, F.coalesce("target_code", F.col(column)).alias(f"{column}_harmonized"), F.coalesce(F.col("targets") > 1, F.lit(False)).alias(f"{column}_ambiguous"))
