"""Boards, survival and flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import schema
from ..functions.exprs import active_role, parse_period
from .diff import first_rows

#: Roles counted on a board, by the column that counts them.
BOARD_COUNTS = {"n_chair": "LEDE", "n_deputy": "NEST", "n_members": "MEDL", "n_alternates": "VARA", "n_observers": "OBS"}


def board_summary(roles: DataFrame, order: Sequence[str] = ("ordering", "entity_org_nr")) -> DataFrame:
    """One row for each organisation (A2): active board rows with a person, counts by role, managers and auditors.

    The auditor is the first active one in ``order``. A role without a group is on no board.
    """
    active = active_role()
    group = lambda code: F.coalesce(F.col("role_group_code") == code, F.lit(False))
    role = lambda code: F.coalesce(F.col("role_code") == code, F.lit(False))
    board = active & group("STYR") & F.col("person_id").isNotNull()
    auditor = active & role("REVI") & F.col("entity_org_nr").isNotNull()
    rank = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    return roles.groupBy("org_nr").agg(
        F.count_if(board).alias("board_size"),
        *[F.count_if(board & role(code)).alias(name) for name, code in BOARD_COUNTS.items()],
        F.count_if(board & F.col("elected_by").isNotNull()).alias("n_employee_elected"),
        F.coalesce(F.bool_or(active & role("DAGL")), F.lit(False)).alias("has_ceo"),
        F.coalesce(F.bool_or(active & role("REVI")), F.lit(False)).alias("has_auditor"),
        F.min_by(F.when(auditor, F.col("entity_org_nr")), F.when(auditor, rank)).alias("auditor_org_nr"),
    )


EXIT_DATES = ("bankruptcy_date", "liquidation_date", "forced_dissolution_date", "deletion_date")


def survival(data: DataFrame, censoring_date: str, entry: str = "founding_date", exits: Sequence[str] = EXIT_DATES) -> DataFrame:
    """``data`` with entry_date, exit_date, event and duration_years.

    The exit is the earliest of the ``exits`` there are; without one, time is censored. Negative durations are NULL.
    """
    if entry not in data.columns:
        raise ValueError(f"no column {entry!r}")
    found = [F.col(c).cast("date") for c in exits if c in data.columns]
    out = F.least(*found) if len(found) > 1 else (found[0] if found else F.lit(None).cast("date"))
    days = F.datediff(F.coalesce(out, F.lit(censoring_date).cast("date")), F.col(entry).cast("date"))
    return data.withColumns({
        "entry_date": F.col(entry).cast("date"), "exit_date": out, "event": out.isNotNull().cast("int"),
        "duration_years": F.when(days >= 0, days / F.lit(365.25)),
    })


def _net(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows (date, by..., entries, exits) summed, by date (T2); groups may be NULL, so one grouping and no join."""
    sums = rows.groupBy("date", *by).agg(F.sum("entries").alias("entries"), F.sum("exits").alias("exits"))
    return sums.withColumn("net", F.col("entries") - F.col("exits")).orderBy("date", *by)


def _between(c: Column, start, end) -> Column:
    ok = F.lit(True)
    if start is not None:
        ok = ok & (c >= F.lit(start).cast("date"))
    if end is not None:
        ok = ok & (c <= F.lit(end).cast("date"))
    return ok


def flows(
    entities: DataFrame, updates: DataFrame | None = None, by: Sequence[str] = (), start=None, end=None,
    legal_form: Sequence[str] | None = None, dedupe: bool = False, date: str = "registration_date",
    order: Sequence[str] = ("registration_date",)
) -> DataFrame:
    """Entries, exits and net change for each day and group (A3, A4).

    Entries are registrations and the feed's insertions, exits its deletions. The feed's rows take their groups from
    the first row of their entity. ``dedupe`` counts an entity once that is both registered and inserted on a day.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    bulk = entities if legal_form is None else entities.where(F.col("legal_form").isin(list(legal_form)))
    rows = bulk.where(F.col(date).isNotNull()).select("org_nr", F.col(date).cast("date").alias("date"), *by, one.alias("entries"), none.alias("exits"))
    if updates is not None:
        attributes = first_rows(entities, ["org_nr"], list(order)).select("org_nr", *by)
        feed = updates.where(F.col("change_type").isin(*schema.INSERTED, *schema.DELETED)).join(attributes, "org_nr", "left")
        new = F.col("change_type").isin(*schema.INSERTED)
        feed = feed.select("org_nr", F.col("timestamp").cast("date").alias("date"), *by, F.when(new, one).otherwise(none).alias("entries"), F.when(new, none).otherwise(one).alias("exits"))
        rows = rows.unionByName(feed)
    if dedupe:
        rows = rows.groupBy("org_nr", "date", *by).agg(F.max("entries").alias("entries"), F.max("exits").alias("exits"))
    return _net(rows.where(_between(F.col("date"), start, end)), by)


def flows_from_changelog(changelog: DataFrame, state: DataFrame | None = None, by: Sequence[str] = (), start=None, end=None) -> DataFrame:
    """The same from a changelog's entries and exits (A4, J5); bounds prune its sync_date partitions."""
    rows = changelog.where(_between(F.col("sync_date"), start, end)).where(F.col("change_type").isin("entry", "exit"))
    rows = rows.withColumn("date", parse_period(F.substring("timestamp", 1, 10)))
    if by:
        rows = rows.join(first_rows(state, ["org_nr"], ["org_nr"]).select("org_nr", *by), "org_nr", "left")
    one = lambda kind: F.when(F.col("change_type") == kind, 1).otherwise(0).cast("long")
    return _net(rows.select("date", *by, one("entry").alias("entries"), one("exit").alias("exits")), by)
