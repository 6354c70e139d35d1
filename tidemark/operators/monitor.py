"""Watching the mirror: freshness, reconciliation, change activity, sessions, health score and alerts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import materialize
from tidemark.functions.columns import at, band, datediff_sql, int_div, percent, shift, value_map
from tidemark.functions.frames import neighbour
from tidemark.sources import schemas
from tidemark.sources.tables import Tables


def freshness(tables: Tables, as_of: datetime, names=("Customer", "Product", "SalesOrderHeader")) -> DataFrame:
    minutes = datediff_sql("minute", F.col("LastModified"), at(as_of))
    rows = [tables[n].agg(F.count("*").alias("RecordCount"), F.max("ModifiedDate").alias("LastModified"))
            .select(F.lit(n).alias("TableName"), "*") for n in names]
    return (reduce(DataFrame.union, rows).withColumn("MinutesSinceLastUpdate", minutes)
            .withColumn("DataFreshness", band("MinutesSinceLastUpdate", [(5, "Real-time"), (30, "Near Real-time"),
                                                                         (60, "Delayed")], "Stale", op="<="))
            .orderBy("TableName"))


def row_hash(columns: list[str]) -> Column:
    """Hash of a row in which a null in one column differs from a null in the next."""
    return F.expr("xxhash64(" + ", ".join(f"isnull(`{c}`), `{c}`" for c in columns) + ")")


#: Key buckets per table whose checksums are compared before any row moves.
CHECK_BUCKETS = 4096
LOW = (1 << 32) - 1


def _sides(pairs: dict[str, tuple[DataFrame, DataFrame | None, str | None]]) -> DataFrame:
    """Every row of every table and side as numbers: (table's place, bucket, key, row hash, +1 or -1). A key that is no whole number
    goes by its hash; without a key a row stands for itself."""
    parts = []
    for place, (source, mirror, key) in enumerate(pairs.values()):
        columns = [c for c in source.columns if (mirror is None or c in mirror.columns) and c != key]
        for df, sign in ((source, 1), (mirror, -1)):
            if df is not None:
                named = df.select(F.lit(place).alias("t"), (_held(df, key) if key else F.lit(None).cast("bigint")).alias("k"),
                                  row_hash([*([key] if key else []), *columns]).alias("h"), F.lit(sign).alias("s"))
                parts.append(named if key else named.withColumn("k", F.col("h")))
    return reduce(DataFrame.unionByName, parts).withColumn("p", _bucket())


def _held(df: DataFrame, key: str) -> Column:
    whole = df.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.col(key).cast("bigint") if whole else F.when(F.col(key).isNotNull(), F.xxhash64(key))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("k"), F.lit(CHECK_BUCKETS)).cast("int")


def _checksums(rows: DataFrame) -> DataFrame:
    """Order-free checksums of every bucket, source less mirror: rows and both halves of their hashes, added up. Sums, unlike an
    exclusive or, also tell two equal rows from none."""
    return _per_key(rows, ["t", "p"])


def _differs() -> Column:
    return (F.col("a") != F.col("b")) | (F.col("low") != 0) | (F.col("high") != 0)


def _open_rows(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """The rows of the buckets that differ and hold rows of both sides: at most tables x CHECK_BUCKETS of them. Of a bucket that one
    side lacks the checksums already say all."""
    return rows.join(F.broadcast(sums.filter(_differs() & (F.col("a") > 0) & (F.col("b") > 0)).select("t", "p")), ["t", "p"])


def _per_key(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Rows of each side and the difference of their hashes: one row per key moves, however many hold it."""
    low, high, sign = F.col("h").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned("h", 32), F.col("s").cast("bigint")
    return rows.groupBy(*keys).agg(F.count_if(F.col("s") > 0).alias("a"), F.count_if(F.col("s") < 0).alias("b"),
                                   F.sum(sign * low).alias("low"), F.sum(sign * high).alias("high"), *more)


def _reconciled(pairs: dict[str, tuple[DataFrame, DataFrame | None, str | None]]) -> DataFrame:
    rows = _sides(pairs)
    sums = materialize(_checksums(rows), "checksums")
    found = _open_rows(rows, sums)
    keyed = F.col("t").isin([i for i, (_, _, key) in enumerate(pairs.values()) if key])
    per_key = materialize(_per_key(found, ["t", "k"]).filter(_differs()), "differing-keys")
    repeated = keyed & ((F.col("a") > 1) | (F.col("b") > 1))
    a, b = F.col("a"), F.col("b")
    pair = F.when(keyed, F.least(a, b)).otherwise(0)
    # a key once on either side at most, or rows that stand for themselves: counts tell
    shared = F.when(keyed, F.lit(0)).otherwise(F.least(a, b))
    parts = [per_key.filter(~repeated).select("t", (a - pair - shared).alias("gone"), (b - pair - shared).alias("new"), pair.alias("changed")),
             sums.filter((a == 0) | (b == 0)).select("t", a.alias("gone"), b.alias("new"), F.lit(0).cast("bigint").alias("changed"))]
    if not per_key.filter(repeated).isEmpty():
        # keys held several times: equal rows meet first, what is left pairs up
        again = found.join(per_key.filter(repeated).select("t", F.col("k").alias("_k")).withColumnRenamed("t", "_t"),
                           (F.col("t") == F.col("_t")) & F.col("k").eqNullSafe(F.col("_k")), "left_semi")
        kinds = again.groupBy("t", "k", "h").agg(F.sum("s").alias("d"))
        left, right = F.greatest(F.col("d"), F.lit(0)), F.greatest(-F.col("d"), F.lit(0))
        keys = kinds.groupBy("t", "k").agg(F.sum(left).alias("gone"), F.sum(right).alias("new"))
        both = F.least("gone", "new")
        parts.append(keys.select("t", (F.col("gone") - both).alias("gone"), (F.col("new") - both).alias("new"), both.alias("changed")))
    changed = reduce(DataFrame.unionByName, parts).groupBy("t").agg(F.sum("gone").alias("MissingRows"), F.sum("new").alias("ExtraRows"), F.sum("changed").alias("ChangedRows"))
    totals = sums.groupBy("t").agg(F.sum("a").alias("SourceRows"), F.sum("b").alias("MirrorRows"))
    names = next(iter(pairs.values()))[0].sparkSession.createDataFrame(list(enumerate(pairs)), "t int, TableName string")

    def known(c: str) -> Column:
        return F.coalesce(c, F.lit(0).cast("bigint")).alias(c)

    counted = ["MissingRows", "ExtraRows", "ChangedRows"]
    out = names.join(totals, "t", "left").join(changed, "t", "left").select(
        "TableName", *[known(c) for c in ("SourceRows", "MirrorRows", *counted)])
    return out.withColumn("InSync", F.col("MissingRows") + F.col("ExtraRows") + F.col("ChangedRows") == 0)


def reconcile(source: DataFrame, mirror: DataFrame, key: str | None, name: str = "") -> DataFrame:
    """Counts of missing, extra and changed rows.

    Rows of one key that the sides do not share pair up as changed; the surplus of a side is missing or extra. Null and
    repeated keys count like any other. Without a key, rows are compared as multisets and none is changed. Checksums of key
    buckets are compared first, and rows move only for buckets that differ: sides in step move nothing but checksums.
    """
    return _reconciled({name: (source, mirror, key)})


def reconcile_all(source: Tables, mirror: Tables) -> DataFrame:
    """Every table of the source against the mirror; a table the mirror lacks counts as not enabled."""
    out = _reconciled({n: (source[n], mirror.get(n), k) for n, k in schemas.KEYS.items() if n in source})
    return out.withColumn("Enabled", F.col("TableName").isin([n for n in schemas.KEYS if n in mirror]))


def reconcile_rows(source: Tables, mirror: Tables) -> DataFrame:
    """The keys of mirrored tables on which the sides differ, and how: MISSING, EXTRA, CHANGED with the names of the columns, or
    REPEATED where a side holds the key several times and the rows do not agree."""
    pairs = {n: (source[n], mirror[n], k) for n, k in schemas.KEYS.items() if k and n in source and n in mirror}
    sums = materialize(_checksums(_sides(pairs)), "checksums")
    parts = []
    for place, (name, (left, right, key)) in enumerate(pairs.items()):
        columns = [c for c in left.columns if c in right.columns and c != key]
        legs = [df.select(F.lit(place).alias("t"), _held(df, key).alias("k"), F.col(key).cast("string").alias("name"), row_hash([key, *columns]).alias("h"), F.lit(sign).cast("bigint").alias("s"),
                          *[row_hash([c]).alias(f"c{i}") for i, c in enumerate(columns)]) for df, sign in ((left, 1), (right, -1))]
        rows = legs[0].unionByName(legs[1]).withColumn("p", _bucket())
        opened = rows.join(F.broadcast(sums.filter(_differs()).select("t", "p")), ["t", "p"])
        per_key = _per_key(opened, ["name"], *[F.bit_xor(f"c{i}").alias(f"c{i}") for i in range(len(columns))])
        kind = (F.when(F.col("b") == 0, "MISSING").when(F.col("a") == 0, "EXTRA").when((F.col("a") == 1) & (F.col("b") == 1), "CHANGED").otherwise("REPEATED"))
        named = F.concat_ws(",", *[F.when(F.col(f"c{i}") != 0, c) for i, c in enumerate(columns)])
        parts.append(per_key.filter(_differs()).select(F.lit(name).alias("TableName"), F.col("name").alias("KeyValue"), kind.alias("Difference"),
                                                       F.when(kind == "CHANGED", named).alias("Columns")))
    return reduce(DataFrame.union, parts)


def failing_items(recon: DataFrame) -> DataFrame:
    """Tables out of step or not mirrored."""
    status = F.when(~F.col("Enabled"), "NOT_ENABLED").when(~F.col("InSync"), "ERROR").otherwise("OK")
    text = F.when(F.col("Enabled") & ~F.col("InSync"), F.concat(
        F.col("MissingRows").cast("string"), F.lit(" missing, "), F.col("ExtraRows").cast("string"), F.lit(" extra, "),
        F.col("ChangedRows").cast("string"), F.lit(" changed")))
    return (recon.select("TableName", "Enabled", "InSync", text.alias("ExceptionMessage"), status.alias("Status"))
            .filter(F.col("Status") != "OK").orderBy("TableName"))


def _row_counts(tables: Tables, names: list[str]) -> DataFrame:
    return reduce(DataFrame.union, [tables[n].agg(F.count("*").alias("CurrentRows"))
                                    .select(F.lit(n).alias("table_name"), "CurrentRows") for n in names])


def change_activity(log: DataFrame, tables: Tables, as_of: datetime, hours: int = 24) -> DataFrame:
    """Modifications within the look-back against table size, per table that changed."""
    changed = (log.filter(F.col("ts") >= shift(at(as_of), hours=-hours)).groupBy("table_name")
               .agg(F.count("*").alias("TotalModifications"), F.max("ts").alias("LastChange")))
    total, rows = F.col("TotalModifications"), F.col("CurrentRows")
    # fixed values: impact texts by number of modifications
    load = band(total, [(10000, "High mirroring load expected"), (1000, "Medium mirroring load expected"),
                        (100, "Low mirroring load expected")], "Minimal mirroring load", op=">")
    level = (F.when(total > rows * 0.5, "VERY_HIGH").when(total > rows * 0.2, "HIGH")
             .when(total > rows * 0.05, "MEDIUM").when(total > 0, "LOW").otherwise("NONE"))
    return (changed.join(_row_counts(tables, ["Customer", "Product", "SalesOrderHeader"]), "table_name")
            .select(F.col("table_name").alias("TableName"), "CurrentRows", "TotalModifications", "LastChange",
                    F.coalesce(percent(total, rows), F.lit(0)).alias("ModificationRatePercent"),
                    level.alias("ActivityClassification"), load.alias("MirroringImpact"))
            .orderBy(F.desc("TotalModifications")))


def activity_levels(log: DataFrame, tables: Tables, mirrored: list[str], as_of: datetime, hours: int = 1) -> DataFrame:
    """Size, recent changes, last change and mirrored flag of every table."""
    since = shift(at(as_of), hours=-hours)
    changed = log.groupBy("table_name").agg(F.count_if(F.col("ts") >= since).alias("recent"),
                                            F.max("ts").alias("LastChange"))
    recent = F.coalesce("recent", F.lit(0))
    return (_row_counts(tables, list(tables)).join(changed, "table_name", "left")
            .select(F.col("table_name").alias("TableName"), "CurrentRows", recent.alias("ModifiedRecently"), "LastChange",
                    F.when(F.col("table_name").isin(mirrored), "YES").otherwise("NO").alias("IsMirrored"),
                    band(recent, [(1000, "HIGH"), (100, "MEDIUM"), (0, "LOW")], "NONE", op=">").alias("ActivityLevel"))
            .orderBy("TableName"))


def metric_rollup(metrics: DataFrame, as_of: datetime, names: dict[str, str], hours: int = 2, ts: str = "ts",
                  kind: str = "event_type", value: str = "value") -> DataFrame:
    """Mean and maximum of each named metric over the look-back, with the sample range; no samples, no row."""
    aggs = [F.count("*").alias("Samples"), F.min(ts).alias("SampleTimeStart"), F.max(ts).alias("SampleTimeEnd")]
    for code, label in names.items():
        x = F.when(F.col(kind) == code, F.col(value).cast("decimal(18,2)"))
        aggs += [(F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))).alias(f"avg_{label}"),
                 F.max(x).alias(f"max_{label}")]
    return metrics.filter(F.col(ts) >= shift(at(as_of), hours=-hours)).agg(*aggs).filter(F.col("Samples") > 0)


def band_durations(found: DataFrame, as_of: datetime) -> DataFrame:
    """Open sessions older than a minute by how long they have run."""
    seconds = datediff_sql("second", F.col("SessionStart"), at(as_of))
    return (found.filter((F.col("SessionState") == "OPEN") & (F.col("SessionStart") < shift(at(as_of), minutes=-1)))
            .withColumn("DurationSeconds", seconds)
            .withColumn("Classification", band("DurationSeconds", [(300, "LONG_RUNNING"), (60, "MODERATE")], "SHORT", ">"))
            .orderBy("SessionStart"))


def session_activity(found: DataFrame, as_of: datetime, hours: int = 2, n: int = 10, user: str = "user_id") -> DataFrame:
    """Latest sessions by start with their duration and how recently they were active."""
    now, last = at(as_of), F.col("LastEvent")
    status = (F.when(last >= shift(now, minutes=-5), "ACTIVE").when(last >= shift(now, minutes=-30), "RECENT")
              .otherwise("IDLE"))
    return (found.filter(F.col("SessionStart") >= shift(now, hours=-hours))
            .select(user, "SessionStart", "SessionEnd", "LastEvent", "DurationMinutes", status.alias("ActivityStatus"))
            .orderBy(F.desc("SessionStart"), user).limit(n))


def error_sessions(found: DataFrame, user: str = "user_id") -> DataFrame:
    """Sessions that hold at least one error."""
    return (found.filter(F.col("Errors") > 0)
            .select(user, "SessionStart", "SessionEnd", "Events", "Errors", "DurationMinutes")
            .orderBy(F.desc("SessionStart")))


def usage_bands(usage: DataFrame, used: Column, size: Column) -> DataFrame:
    """Used share of a capacity, its rest and a health band."""
    share = percent(used, size)
    return usage.select("*", share.alias("UsedPercent"), (F.lit(100) - share).alias("AvailablePercent")).withColumn(
        "HealthStatus", band("UsedPercent", [(90, "CRITICAL"), (75, "WARNING"), (50, "CAUTION")], "HEALTHY", op=">"))


def wait_chains(log: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each error event beside the event of the same user just before it, with the wait banded by impact."""
    prior = neighbour(log.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
                      F.struct("event_id", "event_type", "ts"), "_p", buckets=buckets)
    wait = datediff_sql("second", F.col("_p.ts"), F.col("ts"))
    return (prior.filter(F.col("event_type") == "error")
            .select(F.col("_p.event_id").alias("BlockingEvent"), F.col("event_id").alias("BlockedEvent"), "user_id",
                    F.col("_p.event_type").alias("BlockingType"), wait.alias("WaitSeconds"))
            .withColumn("ImpactLevel", band("WaitSeconds", [(30, "CRITICAL"), (10, "HIGH"), (5, "MEDIUM")], "LOW", ">")))


def facts(recon: DataFrame, found: DataFrame, waits: DataFrame, capacity: Column, as_of: datetime) -> DataFrame:
    """One row with what the health score and the alert rules look at."""
    open_long = (F.col("SessionState") == "OPEN") & (datediff_sql("minute", F.col("SessionStart"), at(as_of)) > 30)
    return recon.agg(
        F.count("*").alias("TotalTables"), F.count_if("Enabled").alias("EnabledTables"),
        F.count_if(F.col("Enabled") & ~F.col("InSync")).alias("FailingTables"),
    ).withColumn("LongSessions", found.agg(F.count_if(open_long)).scalar()) \
     .withColumn("BlockedEvents", waits.agg(F.count_if(F.col("ImpactLevel") == "CRITICAL")).scalar()) \
     .withColumn("UsedPercent", capacity)


def health_score(known: DataFrame) -> DataFrame:
    """Points for feed, coverage, errors and capacity; the first failing check gives the advice."""
    enabled, total = F.col("EnabledTables"), F.col("TotalTables")
    points = known.select(
        F.when(enabled > 0, 40).otherwise(0).alias("FeedScore"),
        int_div(enabled * 30, total).alias("CoverageScore"),
        F.when(F.col("FailingTables") == 0, 20).otherwise(0).alias("ErrorScore"),
        F.when(F.col("UsedPercent") < 75, 10).otherwise(0).alias("CapacityScore"))
    total_score = F.col("FeedScore") + F.col("CoverageScore") + F.col("ErrorScore") + F.col("CapacityScore")
    # fixed values: advice by first failing check
    advice = (F.when(F.col("FeedScore") == 0, "Enable Change Feed for mirroring")
              .when(F.col("CoverageScore") < 30, "Configure more tables for mirroring")
              .when(F.col("ErrorScore") == 0, "Resolve Change Feed exceptions")
              .when(F.col("CapacityScore") == 0, "Monitor transaction log space").otherwise("Mirroring is healthy"))
    return points.select(
        total_score.alias("TotalHealthScore"), "*",
        band(total_score, [(90, "EXCELLENT"), (75, "GOOD"), (60, "FAIR"), (40, "POOR")], "CRITICAL").alias("HealthStatus"),
        advice.alias("PrimaryRecommendation"))


# Action time per category.
TIMELINES = {"CRITICAL": "Immediate action required", "HIGH": "Address within 24 hours",
             "MEDIUM": "Address within a week", "LOW": "Monitor and address as needed"}

# (priority, category, condition on the facts, text)
ALERT_RULES = [
    (1, "CRITICAL", lambda: F.col("EnabledTables") == 0,
     "No table is mirrored. Enable the change feed."),
    (2, "HIGH", lambda: F.col("FailingTables") > 0, "Some mirrored tables are out of step. Review their rows and types."),
    (3, "MEDIUM", lambda: F.col("UsedPercent") > 75, "Log usage is high. Look for long-running work."),
    (4, "MEDIUM", lambda: F.col("LongSessions") > 0, "Long-running sessions found. They may slow mirroring."),
    (5, "LOW", lambda: F.col("BlockedEvents") > 0, "Blocked work found. It may delay mirroring."),
]
ALL_CLEAR = (1, "INFO", "All mirrored tables are enabled and in step, and no limit is exceeded.")


def alerts(known: DataFrame, rules=None) -> DataFrame:
    """Rules that fire on the facts row, in order of priority, or one all-clear row."""
    rules = rules or ALERT_RULES

    def cell(priority, category, text):
        return F.struct(F.lit(priority).alias("Priority"), F.lit(category).alias("Category"), F.lit(text).alias("Recommendation"))

    fired = F.array_compact(F.array(*[F.when(cond(), cell(p, c, t)) for p, c, cond, t in rules]))
    shown = F.when(F.size(fired) > 0, fired).otherwise(F.array(cell(*ALL_CLEAR)))
    return (known.select(F.inline(shown))
            .withColumn("ActionTimeline", value_map("Category", TIMELINES, "For information only")).orderBy("Priority"))
