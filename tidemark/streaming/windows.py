"""Windowed counts, lateness, lag and sessions over a change log.

Each is made of a *part*, which reduces any set of rows, and a *whole*, which merges parts. On a table the part is taken once;
a stream appends the part of each micro-batch and readers take the whole of all parts, so no row is too late to
count and the latest windows show.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import at, band, datediff_sql


def count_part(changes: DataFrame, interval: str = "1 hour") -> DataFrame:
    op = F.col("op")
    return changes.groupBy(F.window("ts", interval).alias("w"), "table_name").agg(
        F.count_if(op == "I").alias("Inserts"), F.count_if(op == "U").alias("Updates"),
        F.count_if(op == "D").alias("Deletes"), F.count_if(op == "R").alias("Restores"), F.count("*").alias("Changes"),
    ).select(F.col("w.start").alias("WindowStart"), F.col("w.end").alias("WindowEnd"), "table_name", "Inserts", "Updates",
             "Deletes", "Restores", "Changes")


def count_whole(parts: DataFrame) -> DataFrame:
    names = ["Inserts", "Updates", "Deletes", "Restores", "Changes"]
    return (parts.groupBy("WindowStart", "WindowEnd", "table_name").agg(*[F.sum(c).alias(c) for c in names])
            .withColumn("ActivityLevel", band("Changes", [(1000, "HIGH"), (100, "MEDIUM"), (0, "LOW")], "NONE", op=">")))


def change_counts(changes: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Inserts, updates, deletes and restores per table and tumbling window, with an activity level."""
    return count_whole(count_part(changes, interval))


def late_part(log: DataFrame, arrived: str = "arrived", interval: str = "1 hour") -> DataFrame:
    """Changes per table, arrival window and time of change: which of them are late shows only when all are known."""
    return log.groupBy("table_name", F.window(arrived, interval)["start"].alias("w"), "ts").agg(F.count("*").alias("n"))


def late_whole(parts: DataFrame, allowed: str = "INTERVAL 1 HOUR") -> DataFrame:
    newest = parts.groupBy("table_name", "w").agg(F.max("ts").alias("newest"))
    earlier = Window.partitionBy("table_name").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)  # one per window
    mark = newest.select("table_name", "w", (F.max("newest").over(earlier) - F.expr(allowed)).alias("mark"))
    late = F.when(F.col("ts") < F.col("mark"), F.col("n")).otherwise(0)
    return (parts.join(mark, ["table_name", "w"], "left")
            .groupBy(F.col("w").alias("WindowStart"), "table_name")
            .agg(F.sum("n").alias("Changes"), F.sum(late).alias("LateChanges")))


def late_changes(log: DataFrame, arrived: str = "arrived", interval: str = "1 hour",
                 allowed: str = "INTERVAL 1 HOUR") -> DataFrame:
    """Changes per table and arrival window, and how many of them are older than the newest change of all earlier
    windows by more than the allowed delay."""
    return late_whole(late_part(log, arrived, interval), allowed)


def replication_lag(log: DataFrame, applied: str = "arrived", interval: str = "1 day") -> DataFrame:
    """Seconds from source change to application per table and window: mean, median, 95th percentile and maximum.

    Rows are counted per second of lag first; a percentile is then the smallest lag that so many rows do not exceed.
    """
    lag = datediff_sql("second", F.col("ts"), F.col(applied))
    group = ["WindowStart", "table_name"]
    counted = log.groupBy(F.window("ts", interval)["start"].alias("WindowStart"), "table_name", lag.alias("lag")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*group).orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)  # one row per second of lag
    known = F.col("lag").isNotNull()
    placed = counted.withColumn("upto", F.sum(F.when(known, F.col("n")).otherwise(0)).over(upto)).withColumn(
        "total", F.sum(F.when(known, F.col("n")).otherwise(0)).over(Window.partitionBy(*group)))

    def percentile(share: str):
        rank = F.ceil(F.col("total") * F.lit(share).cast("decimal(4,2)"))
        return F.min(F.when(known & (F.col("upto") >= rank), F.col("lag")))

    return placed.groupBy(*group).agg(
        F.sum("n").alias("Changes"), (F.sum(F.col("lag") * F.col("n")).cast("double") / F.sum(F.when(known, F.col("n")))).alias("AvgLagSeconds"),
        percentile("0.50").alias("MedianLagSeconds"), percentile("0.95").alias("P95LagSeconds"), F.max("lag").alias("MaxLagSeconds"))


def session_part(log: DataFrame, gap_minutes: int = 30, user: str = "user_id", ts: str = "ts",
                 is_error: Column | None = None) -> DataFrame:
    """One row per user and gap-long slot: events in one slot always belong together."""
    error = F.lit(False) if is_error is None else is_error
    return (log.groupBy(user, F.floor(F.unix_timestamp(ts) / (gap_minutes * 60)).alias("slot"))
            .agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.count("*").alias("n"), F.count_if(error).alias("e")))


def sessions(log: DataFrame, as_of: datetime, gap_minutes: int = 30, user: str = "user_id", ts: str = "ts",
             is_error: Column | None = None) -> DataFrame:
    """Sessions of a user: runs of events less than ``gap_minutes`` apart.

    What is sorted per user is bounded by the time span over the gap, not by the number of events. A session whose
    last event is within the gap of ``as_of`` is still open and has no end.
    """
    return session_whole(session_part(log, gap_minutes, user, ts, is_error), as_of, gap_minutes, user)


def session_whole(parts: DataFrame, as_of: datetime, gap_minutes: int = 30, user: str = "user_id") -> DataFrame:
    slots = parts.groupBy(user, "slot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.sum("e").alias("e"))
    by_user = Window.partitionBy(user).orderBy("slot")
    gap = F.make_dt_interval(mins=F.lit(gap_minutes))
    starts = F.when(F.col("lo") < F.lag("hi").over(by_user) + gap, 0).otherwise(1)
    numbered = slots.withColumn("new", starts).withColumn(
        "session", F.sum("new").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
    found = numbered.groupBy(user, "session").agg(
        F.min("lo").alias("SessionStart"), F.max("hi").alias("_last"), F.sum("n").alias("Events"),
        F.sum("e").alias("Errors"))
    now = at(as_of)
    end = F.when(F.col("_last") <= now - gap, F.col("_last"))
    return found.select(
        user, "SessionStart", end.alias("SessionEnd"), "Events", "Errors",
        datediff_sql("minute", F.col("SessionStart"), F.coalesce(end, now)).alias("DurationMinutes"),
        F.col("_last").alias("LastEvent"),
        F.when(end.isNull(), "OPEN").otherwise("CLOSED").alias("SessionState"))
