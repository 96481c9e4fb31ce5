"""Change propagation (M2, R1): which Bronze partitions a run has not seen.

Every ingest leaves one *commit* per (target table, event day, source, batch)
in ``bronze/commits``; a replayed batch gets a new commit id.  A nightly run
ends by copying the commits it consumed to ``silver/consumed``, its high-water
mark per input.  What was committed and is not consumed is *pending*, and a
day is *open* once a run has processed it.  So a later run finds the events
that arrived for days already reported, and a run that fails in between
leaves them pending.

Days are calendar days: their lists are as long as the calendar, whatever
the number of events, and may be held by the driver to prune partitions.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BRONZE_TABLE, PAYMENT, SETTLEMENT

COMMIT = "target_table string, event_day string, ingest_source string, ingest_batch long, commit string"
COMMIT_KEYS = ["target_table", "event_day", "ingest_source", "ingest_batch", "commit"]
#: ``ingest_source`` of the rows that say that a day has been processed.
OPENED = "(day opened)"


def day_of_partition() -> Column:
    """``yyyy-MM-dd`` of Bronze's year, month and day strings (NULL: no time)."""
    return F.concat_ws("-", F.when(F.col("year").isNotNull(), F.col("year")), "month", "day")


def observed_days() -> Column:
    """Aggregate for ``observe``: the (target table, day) pairs of a batch."""
    return F.collect_set(F.struct("target_table", day_of_partition().alias("event_day")))


def record_commits(lake, pairs: Iterable, source: str, batch_id: int) -> None:
    """One commit per (target, day) of the batch; a replay replaces them."""
    commit = uuid.uuid4().hex
    rows = [(p["target_table"], p["event_day"] or None, source, int(batch_id), commit) for p in pairs]
    lake.replace_partitions(lake.spark.createDataFrame(rows, COMMIT), "bronze", "commits",
                            ["ingest_source", "ingest_batch"], rebalance=False)


def commits(lake) -> DataFrame:
    return lake.read_or_empty("bronze", "commits", lake.spark.createDataFrame([], COMMIT).schema).select(*COMMIT_KEYS)


def consumed(lake) -> DataFrame:
    return lake.read_or_empty("silver", "consumed", lake.spark.createDataFrame([], COMMIT).schema).select(*COMMIT_KEYS)


def pending(lake) -> DataFrame:
    """Commits that no run has consumed."""
    return commits(lake).subtract(consumed(lake))


def open_days(lake) -> DataFrame:
    return consumed(lake).filter(F.col("ingest_source") == OPENED).select("event_day").distinct()


#: Inputs of the day-partitioned tables; the others are due whatever their day.
BY_DAY = (BRONZE_TABLE[PAYMENT], BRONZE_TABLE[SETTLEMENT])


def due(lake, report_date: str | None) -> DataFrame:
    """Pending commits a run for ``report_date`` consumes: payments and
    settlements of that day and of days processed before (late arrivals),
    and all other events; everything for a catch-up."""
    todo = pending(lake)
    if report_date is None:
        return todo
    days = open_days(lake).unionByName(
        lake.spark.createDataFrame([(report_date,)], "event_day string")).distinct()
    by_day = F.col("target_table").isin(*BY_DAY)
    return todo.filter(by_day).join(days, "event_day", "left_semi").select(*COMMIT_KEYS) \
        .unionByName(todo.filter(~by_day))


def mark_dirty(lake, days: Iterable[str]) -> None:
    """Days about to change, noted before they do: a run that fails after the
    change leaves them for the next one."""
    lake.append(lake.spark.createDataFrame([(d,) for d in days], "day string").coalesce(1), "silver", "dirty_days")


def dirty_days(lake) -> list[str]:
    if not lake.exists("silver", "dirty_days"):
        return []
    return sorted(r[0] for r in lake.read("silver", "dirty_days").distinct().collect())


def clear_dirty(lake) -> None:
    lake._delete(lake.path("silver", "dirty_days"))


def days_of(frame: DataFrame, target_table: str) -> list[str]:
    """Days of one input among due commits (as many as the calendar has)."""
    rows = frame.filter((F.col("target_table") == target_table) & F.col("event_day").isNotNull()) \
        .select("event_day").distinct().collect()
    return sorted(r[0] for r in rows)


def mark_consumed(lake, frame: DataFrame, days: Iterable[str]) -> None:
    """Append the consumed commits and the days processed."""
    opened = lake.spark.createDataFrame([("", d, OPENED, 0, "") for d in days], COMMIT)
    lake.append(frame.unionByName(opened).coalesce(1), "silver", "consumed")
