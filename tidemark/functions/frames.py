"""Frame helpers that keep ordered work distributed: exact ranks, scores and positions without a one-task sort,
neighbouring rows and carried values without one task per key, shares of a total, a calendar.

All ordered helpers cut the range of the ordering value into buckets. Where the cuts lie only affects balance, never
results: equal values share a bucket and buckets follow the order of the values.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import materialize
from tidemark.functions.columns import at, fiscal_year, half_up, ratio, shift, week_of_year_sql

_COMMON = "decimal(38,8)"  # holds whole numbers and money alike when several metrics are ranked in one pass


def default_buckets(spark: SparkSession) -> int:
    """Power of two, about four buckets per shuffle partition."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(64, 1 << (wanted - 1).bit_length())


def cut_points(df: DataFrame, column: str, buckets: int) -> Column:
    """Up to ``buckets - 1`` sorted values of ``column`` that split it roughly evenly, as a scalar subquery.

    A uniform sample of the distinct values: of all values whose hash falls in a slot, the one with the smallest
    second hash. It combines map-side to one row per slot, depends on the data alone, and works for any ordered type.
    """
    c = F.col(column)
    slots = (df.filter(c.isNotNull()).groupBy(F.pmod(F.xxhash64(c), F.lit(buckets - 1)).alias("slot"))
             .agg(F.min_by(c, F.xxhash64(c, F.lit(1))).alias("v")))
    return slots.agg(F.sort_array(F.collect_list("v"))).scalar()


def with_bucket(df: DataFrame, column: str, out: str, buckets: int, sample: DataFrame | None = None) -> DataFrame:
    """Add the bucket number of ``column``: how many cut points lie below it, found by binary search. Nulls get -1."""
    c = F.col(column)
    cur = df.withColumn("_cuts", cut_points(df if sample is None else sample, column, buckets)).withColumn(out, F.lit(0))
    step = buckets // 2
    while step:
        cur = cur.withColumn(out, F.when(F.get("_cuts", F.col(out) + (step - 1)) < c, F.col(out) + step)
                             .otherwise(F.col(out)))
        step //= 2
    return cur.withColumn(out, F.when(c.isNull(), -1).otherwise(F.col(out))).drop("_cuts")


def value_ranks(df: DataFrame, columns: list[str], by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact RANK of every distinct value, ascending and descending, per metric column and group:
    ``(by..., metric, value, rank_asc, rank_desc)``.

    RANK depends only on how many rows lie before a value, so rows are first counted per value: a value shared by a
    third of all rows becomes one row before anything is sorted. The running count is taken inside each bucket and
    shifted by the rows of the buckets before it. Nulls are the lowest values. Several columns are ranked in one pass.
    """
    by = by or []
    buckets = buckets or default_buckets(df.sparkSession)
    # groups travel as one struct: null members compare equal there, so plain equality keeps the partitioning
    groups = [F.struct(*by).alias("g")] if by else []
    names = ["g"] if by else []
    if len(columns) == 1:
        stacked = df.select(*groups, F.lit(0).alias("metric"), F.col(columns[0]).alias("value"))
    else:
        cells = [F.struct(F.lit(i).alias("metric"), F.col(c).cast(_COMMON).alias("value")) for i, c in enumerate(columns)]
        stacked = df.select(*groups, F.inline(F.array(*cells)))
    counts = stacked.groupBy(*names, "metric", "value").agg(F.count("*").alias("n"))
    placed = with_bucket(counts, "value", "bucket", buckets)

    cell = [*names, "metric", "bucket"]
    inside = Window.partitionBy(*cell).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*names, "metric")
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows per group
    offsets = placed.groupBy(*cell).agg(F.sum("n").alias("size")).select(
        *cell, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"), F.sum("size").over(whole).alias("total"))
    if not by:
        offsets = F.broadcast(offsets)  # metrics x buckets rows at most
    ahead = placed.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    before = F.col("offset") + F.col("ahead")
    return ahead.join(offsets, cell).select(
        *[F.col("g")[b].alias(b) for b in by], "metric", "value", (before + 1).alias("rank_asc"),
        (F.col("total") - before - F.col("n") + 1).alias("rank_desc"))


def rank_many(df: DataFrame, specs: list[tuple[str, str, bool]], by: list[str] | None = None,
              buckets: int | None = None, key: str | None = None) -> DataFrame:
    """Add exact ranks: ``specs`` lists (column, output name, ascending). Pass a stored frame or a plain scan, since the
    frame is read once for the ranks and once for the rows.

    With ``key``, a column unique in ``df``, only key and values move to the ranks: they become one row per key, and the
    wide rows are joined once.
    """
    by = by or []
    columns = list(dict.fromkeys(c for c, _, _ in specs))
    ranks = value_ranks(df, columns, by, buckets)
    if key:
        return _ranked_by_key(df, specs, by, columns, ranks, key)
    if len(columns) > 1:  # stored, or the filter per metric would run the whole pass once for each
        ranks = materialize(ranks, "ranks")
    cast = (lambda c: c) if len(columns) == 1 else (lambda c: c.cast(_COMMON))
    out = df
    for column, name, ascending in specs:
        side = ranks.filter(F.col("metric") == columns.index(column)).select(
            *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("value").alias("_value"),
            F.col("rank_asc" if ascending else "rank_desc").alias(name))
        cond = cast(out[column]).eqNullSafe(side["_value"])
        for i, b in enumerate(by):
            cond = cond & out[b].eqNullSafe(side[f"_by{i}"])
        out = out.join(side, cond, "left").drop("_value", *[f"_by{i}" for i in range(len(by))])
    return out


def _ranked_by_key(df: DataFrame, specs: list[tuple[str, str, bool]], by: list[str], columns: list[str], ranks: DataFrame,
                   key: str) -> DataFrame:
    cast = (lambda c: c) if len(columns) == 1 else (lambda c: c.cast(_COMMON))
    cells = [F.struct(F.lit(i).alias("_metric"), cast(F.col(c)).alias("_value")) for i, c in enumerate(columns)]
    narrow = df.select(F.col(key).alias("_key"), *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.inline(F.array(*cells)))
    side = ranks.select(*[F.col(b).alias(f"_of{i}") for i, b in enumerate(by)], "metric", "value", "rank_asc", "rank_desc")
    cond = (F.col("_metric") == F.col("metric")) & F.col("_value").eqNullSafe(F.col("value"))
    for i in range(len(by)):
        cond = cond & F.col(f"_by{i}").eqNullSafe(F.col(f"_of{i}"))
    picked = [F.max(F.when(F.col("metric") == columns.index(c), F.col("rank_asc" if up else "rank_desc"))).alias(n) for c, n, up in specs]
    per_key = narrow.join(side, cond).groupBy("_key").agg(*picked)
    return df.join(per_key, F.col(key) == F.col("_key"), "left").drop("_key")


def rank_global(df: DataFrame, order_col: str, out: str, ascending: bool = False, buckets: int | None = None) -> DataFrame:
    return rank_many(df, [(order_col, out, ascending)], None, buckets)


def rank_in_groups(df: DataFrame, group: str, metric: str, out: str, buckets: int | None = None) -> DataFrame:
    """Descending RANK inside each group; a group of any size is sorted bucket by bucket."""
    return rank_many(df, [(metric, out, False)], [group], buckets)


def quantile_scores(df: DataFrame, specs: list[tuple[str, str, bool]], n: int = 5, buckets: int | None = None,
                    key: str | None = None) -> DataFrame:
    """Scores 1..n by global rank for (column, output name, ascending); equal values always share a score."""
    rows = df.agg(F.count("*")).scalar()
    out = rank_many(df, [(c, name, asc) for c, name, asc in specs], None, buckets, key)
    for _, name, _ in specs:
        out = out.withColumn(name, F.call_function("div", (F.col(name) - 1) * n, rows) + 1)
    return out


def dense_positions(df: DataFrame, key: str, out: str, start: Column, buckets: int | None = None) -> DataFrame:
    """Consecutive numbers from ``start`` + 1 in the order of a unique business key."""
    return rank_global(df, key, "_pos", True, buckets).withColumn(out, start + F.col("_pos")).drop("_pos")


def _stretches(packed: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """Add ``_chunk``, the stretch of its key a row lies in, and ``_heavy``, whether the key has several."""
    sizes = packed.groupBy("_key").agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    # a key's stretches follow its share of the rows: fewer than ``buckets`` keys, and below 2 x ``buckets`` stretches in all
    heavy = sizes.filter(F.col("_n") * buckets > total).select("_key", F.ceil(F.col("_n") * buckets / total).cast("int").alias("_slots"))
    tuple_ = F.struct(*order)
    # of the rows whose order values hash to one slot, the one with the smallest second hash: a uniform sample of rows
    slot = F.pmod(F.xxhash64(*order), F.col("_slots"))
    cuts = (packed.select("_key", *order).join(F.broadcast(heavy), "_key").groupBy("_key", slot.alias("_slot"))
            .agg(F.min_by(tuple_, F.xxhash64(*order, F.lit(1))).alias("_v")).groupBy("_key").agg(F.sort_array(F.collect_list("_v")).alias("_cuts")))
    marked = packed.join(F.broadcast(cuts), "_key", "left").withColumn("_chunk", F.lit(0))
    step = 1 << (buckets - 1).bit_length()
    while step:  # binary search: how many cuts lie below the row
        marked = marked.withColumn("_chunk", F.when(F.get("_cuts", F.col("_chunk") + (step - 1)) < tuple_, F.col("_chunk") + step).otherwise(F.col("_chunk")))
        step //= 2
    return marked.withColumn("_heavy", F.col("_cuts").isNotNull()).drop("_cuts")


def ordered_pass(df: DataFrame, keys: list[str], order: list[str], fill: list[str] | None = None,
                 lag: dict[str, Column] | None = None, lead: dict[str, Column] | None = None,
                 buckets: int | None = None, cumulative: dict[str, Column] | None = None) -> DataFrame:
    """Values of the previous row (``lag``), the next row (``lead``), the latest earlier non-null value (``fill``, in
    place) and the sum up to the row (``cumulative``, null before the first value) of the same key. ``order`` must identify a row
    within its key. Without ``keys`` all rows are one key's.

    A plain window sends all rows of a key to one task. Here the rows of every key that holds more than one part in
    ``buckets`` of all rows are split into stretches of the whole order, cut by a sample of the key's own rows, so
    rows bunched in time and ties of the first column are split too. The window runs inside a stretch, and values
    that cross its edge come from the nearest other stretches of the key; sums start from the total of the stretches
    before. All other keys are one stretch each.
    """
    fill, lag, lead, cumulative = fill or [], lag or {}, lead or {}, cumulative or {}
    buckets = buckets or default_buckets(df.sparkSession)
    # keys travel as one struct: null members compare equal there, so plain equality keeps the window's partitioning
    # without keys: always 0, but no constant, or the joins on it would become table products
    packed = df.select(F.struct(*(keys or [F.pmod(F.xxhash64(*order), F.lit(1)).alias("all")])).alias("_key"), *[c for c in df.columns if c not in keys])
    placed = _stretches(packed, order, buckets)
    inside = Window.partitionBy("_key", "_chunk").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.select(
        "*", *([F.lag(F.lit(1), 1).over(inside).isNull().alias("_first")] if lag else []),
        *([F.lead(F.lit(1), 1).over(inside).isNull().alias("_last")] if lead else []),
        *[F.lag(v, 1).over(inside).alias(f"_in_{n}") for n, v in lag.items()],
        *[F.lead(v, 1).over(inside).alias(f"_in_{n}") for n, v in lead.items()],
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"_in_{c}") for c in fill],
        *[F.sum(v).over(so_far).alias(f"_in_{n}") for n, v in cumulative.items()])
    # a single order column keeps the aggregation buffers primitive, hence hashed rather than sorted
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    edges = placed.filter("_heavy").groupBy("_key", "_chunk").agg(
        *[F.max_by(v, place).alias(f"_e_{n}") for n, v in lag.items()],
        *[F.min_by(v, place).alias(f"_e_{n}") for n, v in lead.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_e_{c}") for c in fill],
        *[F.sum(v).alias(f"_e_{n}") for n, v in cumulative.items()])
    across = Window.partitionBy("_key").orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "_key", "_chunk", *[F.lag(f"_e_{n}", 1).over(across).alias(f"_c_{n}") for n in lag],
        *[F.lead(f"_e_{n}", 1).over(across).alias(f"_c_{n}") for n in lead],
        *[F.last(f"_e_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in fill],
        *[F.sum(f"_e_{n}").over(before).cast(rows.schema[f"_in_{n}"].dataType).alias(f"_c_{n}") for n in cumulative])
    kept = [F.col("_key")[c].alias(c) if c in keys
            else F.coalesce(f"_in_{c}", f"_c_{c}").alias(c) if c in fill else F.col(c) for c in df.columns]
    return rows.join(carried, ["_key", "_chunk"], "left").select(
        *kept, *[F.when(F.col("_first"), F.col(f"_c_{n}")).otherwise(F.col(f"_in_{n}")).alias(n) for n in lag],
        *[F.when(F.col("_last"), F.col(f"_c_{n}")).otherwise(F.col(f"_in_{n}")).alias(n) for n in lead],
        *[F.coalesce(F.col(f"_in_{n}") + F.col(f"_c_{n}"), f"_in_{n}", f"_c_{n}").cast(rows.schema[f"_in_{n}"].dataType).alias(n) for n in cumulative])


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], buckets: int | None = None) -> DataFrame:
    """Sums up to each row of its key, or of all rows without ``keys``, as distributed prefix sums."""
    return ordered_pass(df, keys, order, buckets=buckets, cumulative=sums)


def neighbour(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, forward: bool = False,
              buckets: int | None = None) -> DataFrame:
    """Value of the previous (or next) row of the same key."""
    side = {"lead" if forward else "lag": {out: value}}
    return ordered_pass(df, keys, order, buckets=buckets, **side)


def share_of_total(df: DataFrame, column: str, out: str, by: str | None = None, digits: int = 2) -> DataFrame:
    """Percentage of the grand total, or of the group total.

    The grand total is a scalar subquery and each group total a map-side combined aggregate joined back, so no window
    ever holds one group's rows in a single task.
    """
    if by is None:
        total = df.agg(F.sum(column)).scalar()
        return df.withColumn(out, half_up(ratio(F.col(column), total) * 100, digits))
    totals = df.groupBy(F.col(by).alias("_group")).agg(F.sum(column).alias("_total"))
    joined = df.join(totals, df[by].eqNullSafe(totals["_group"]), "left")
    return joined.select(*[df[c] for c in df.columns],
                         half_up(ratio(df[column], F.col("_total")) * 100, digits).alias(out))


def date_dim(spark: SparkSession, start: date | Column, as_of: datetime) -> DataFrame:
    """Calendar from ``start`` (a date or a scalar subquery) to one year after ``as_of``, with no length limit."""
    now = at(as_of)
    first = start if isinstance(start, Column) else F.lit(start)
    days = spark.range(1).select(
        F.explode(F.sequence(first.cast("date"), F.to_date(shift(now, years=1)))).alias("Date"))
    d = F.col("Date")
    midnight = d.cast("timestamp")

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    same_year = F.year(d) == F.year(now)
    return days.select(
        "Date",
        F.year(d).alias("Year"), F.month(d).alias("Month"), F.day(d).alias("Day"), F.quarter(d).alias("Quarter"),
        week_of_year_sql(d).alias("WeekOfYear"), F.dayofyear(d).alias("DayOfYear"),
        F.date_format(d, "MMMM").alias("MonthName"), F.date_format(d, "EEEE").alias("WeekdayName"),
        F.dayofweek(d).alias("WeekdayNumber"), fiscal_year(d).alias("FiscalYear"),
        flag(midnight >= shift(now, days=-30)).alias("IsLast30Days"),
        flag(midnight >= shift(now, days=-90)).alias("IsLast90Days"),
        flag(same_year).alias("IsCurrentYear"),
        flag(F.year(d) == F.year(now) - 1).alias("IsLastYear"),
        flag(same_year & (F.month(d) == F.month(now))).alias("IsCurrentMonth"),
    ).orderBy("Date")
