"""Folding an ordered change feed into current rows, and the edits a feed carries.

A change sets some columns (I, U), deletes (flags) a row (D), restores it (R) or purges it for good (P). Updates never touch the
delete flag, so the current row is not the latest change: each column keeps the value of the last change that set it. A
purge takes with it whatever was set before; what is set after it makes a new row. All of that is expressed as
``max`` / ``max_by`` on the sequence number, which merges in any order and any number of times.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import materialize
from tidemark.functions.columns import at, is_active, is_deleted
from tidemark.functions.frames import dense_positions, neighbour, ordered_pass
from tidemark.sources import schemas

KEY = ["table_name", "key"]


def to_deltas(changes: DataFrame, columns: list[str], key: list[str] = KEY, mask: str | None = None) -> DataFrame:
    """One state-shaped row per change.

    ``mask`` names an array column listing the columns a change sets, so an explicit null can win; without it a
    change sets its non-null columns.
    """
    seq, op = F.col("seq"), F.col("op")
    lives = ~op.eqNullSafe("P")

    def sets(c: str) -> Column:
        return (F.array_contains(mask, c) if mask else F.col(c).isNotNull()) & lives

    return changes.select(
        *key,
        *[F.when(sets(c), F.col(c)).alias(c) for c in columns],
        *[F.when(sets(c), seq).alias(f"{c}__seq") for c in columns],
        F.when(op == "D", seq).alias("delete_seq"), F.when(op == "R", seq).alias("restore_seq"),
        F.when(op == "D", F.col("ts")).alias("delete_ts"), F.when(op == "D", F.col("actor")).alias("delete_actor"),
        F.when(~lives, seq).alias("purge_seq"), F.when(lives, seq).alias("last_seq"), F.when(lives, F.col("ts")).alias("last_ts"))


def merge_deltas(deltas: DataFrame, columns: list[str], key: list[str] = KEY) -> DataFrame:
    """Fold state-shaped rows to one per key. Associative, commutative and idempotent."""
    return deltas.groupBy(*key).agg(
        *[F.max_by(c, f"{c}__seq").alias(c) for c in columns],
        *[F.max(f"{c}__seq").alias(f"{c}__seq") for c in columns],
        F.max("delete_seq").alias("delete_seq"), F.max("restore_seq").alias("restore_seq"),
        F.max_by("delete_ts", "delete_seq").alias("delete_ts"),
        F.max_by("delete_actor", "delete_seq").alias("delete_actor"), F.max("purge_seq").alias("purge_seq"),
        F.max("last_seq").alias("last_seq"), F.max_by("last_ts", "last_seq").alias("last_ts"))


def outlive_purge(state: DataFrame, columns: list[str], horizon: int | None = None) -> DataFrame:
    """A folded state without what its purges took. A purged key stays as a tombstone, so that an older change that comes
    late does not bring it back; up to ``horizon``, the sequence number below which no change can come any more, it goes."""
    def after(seq: str) -> Column:
        return F.col("purge_seq").isNull() | (F.col(seq) > F.col("purge_seq"))

    guard = {c: f"{c}__seq" for c in columns} | {"delete_ts": "delete_seq", "delete_actor": "delete_seq", "last_ts": "last_seq"}
    guard |= {seq: seq for seq in (*[f"{c}__seq" for c in columns], "delete_seq", "restore_seq", "last_seq")}
    kept = state.select(*[F.when(after(guard[c]), F.col(c)).alias(c) if c in guard else F.col(c) for c in state.columns])
    if horizon is None:
        return kept
    spent = F.coalesce(F.col("purge_seq") <= horizon, F.lit(False))
    return kept.filter(~spent | F.col("last_seq").isNotNull()).withColumn("purge_seq", F.when(~spent, F.col("purge_seq")))


def current_rows(state: DataFrame, columns: list[str], key: list[str] = KEY) -> DataFrame:
    """Readable rows of a folded state: payload, delete audit columns, last modification. Purged rows are not there."""
    state = outlive_purge(state, columns).filter("last_seq is not null")
    gone = F.coalesce(F.col("delete_seq") > F.col("restore_seq"), F.col("delete_seq").isNotNull())
    return state.select(*key, *columns, gone.alias("IsDeleted"), F.when(gone, F.col("delete_ts")).alias("DeletedDate"),
                        F.when(gone, F.col("delete_actor")).alias("DeletedBy"), F.col("last_ts").alias("ModifiedDate"),
                        F.col("last_seq").alias("LastSeq"))


def fold_changes(changes: DataFrame, columns: list[str], key: list[str] = KEY, mask: str | None = None) -> DataFrame:
    return merge_deltas(to_deltas(changes, columns, key, mask), columns, key)


def apply_changes(state: DataFrame, changes: DataFrame, columns: list[str], key: list[str] = KEY,
                  mask: str | None = None) -> DataFrame:
    """State after a batch. The batch is folded first, so at most two rows per key meet in the merge."""
    return merge_deltas(state.unionByName(fold_changes(changes, columns, key, mask)), columns, key)


def dedupe_feed(changes: DataFrame, watermark: str | None = None) -> DataFrame:
    """Each ``(table, key, seq)`` once; for a stream within the watermark."""
    ident = ["table_name", "key", "seq"]
    if changes.isStreaming:
        return changes.withWatermark("ts", watermark or "1 hour").dropDuplicatesWithinWatermark(ident)
    return changes.dropDuplicates(ident)


def history(changes: DataFrame, columns: list[str], key: list[str] = KEY, buckets: int | None = None) -> DataFrame:
    """Every version of every key with its validity interval; columns hold the value in force after the change."""
    versions = ordered_pass(changes.select(*key, "seq", "ts", "op", *columns), key, ["seq"], fill=columns,
                            lead={"valid_to": F.col("ts")}, buckets=buckets)
    return versions.select(*key, "seq", "op", *columns, F.col("ts").alias("valid_from"), "valid_to",
                           F.col("valid_to").isNull().alias("is_current"))


def price_history(changes: DataFrame, price: str = "set_value", key: list[str] = KEY, buckets: int | None = None) -> DataFrame:
    """Price-setting changes with the price before each."""
    priced = changes.filter(F.col(price).isNotNull()).select(*key, "seq", "ts", price)
    return neighbour(priced, key, ["seq"], F.col(price), "PreviousPrice", buckets=buckets)


# --- edits on whole tables ------------------------------------------------------------------------------------------

def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add the delete audit columns that are missing; existing ones stay as they are."""
    for name, kind in schemas.AUDIT_COLUMNS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(False if name == "IsDeleted" else None).cast(kind))
    return df


def insert_rows(df: DataFrame, rows: DataFrame, ts: datetime) -> DataFrame:
    """Append new rows: audit columns at their defaults, modification time stamped, absent columns null."""
    new = with_audit_columns(rows.drop(*schemas.AUDIT_COLUMNS)).withColumn("ModifiedDate", at(ts))
    return df.unionByName(new, allowMissingColumns=True)


def assign_keys(rows: DataFrame, existing: DataFrame, key: str, business_key: str,
                buckets: int | None = None) -> DataFrame:
    """Give new rows the integers after the highest existing key, in the order of the business key. Rows that share one
    get different keys, in the order of their other columns."""
    top = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    bare = rows.drop(key)
    # equal business keys share a rank; the place among them makes the number unique
    others = [F.col(c) for c in bare.columns if c != business_key]
    tied = Window.partitionBy(business_key).orderBy(*others, F.monotonically_increasing_id()) if others else Window.partitionBy(business_key).orderBy(F.monotonically_increasing_id())
    placed = dense_positions(bare, business_key, key, top, buckets).withColumn("_tie", F.row_number().over(tied) - 1)
    return placed.withColumn(key, F.col(key) + F.col("_tie")).drop("_tie")


def update_where(df: DataFrame, where: Column, sets: dict[str, Column], ts: datetime) -> DataFrame:
    """Rewrite the named columns of the rows meeting ``where`` and stamp them; nothing else changes."""
    hit = F.coalesce(where, F.lit(False))
    changed = {c: F.when(hit, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in sets.items()}
    changed["ModifiedDate"] = F.when(hit, at(ts)).otherwise(F.col("ModifiedDate"))
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


def update_from(df: DataFrame, dim: DataFrame, on: str, sets: dict[str, Column], ts: datetime,
                where: Column | None = None) -> DataFrame:
    """Update driven by a join: rows with a partner in ``dim`` (unique on ``on``) are rewritten."""
    names = {c: f"_dim_{c}" for c in dim.columns if c != on}
    side = dim.select(on, *[F.col(c).alias(n) for c, n in names.items()], F.lit(True).alias("_met"))
    joined = df.join(side, on, "left")
    hit = F.coalesce(F.col("_met"), F.lit(False)) & (F.lit(True) if where is None else where)
    return update_where(joined, hit, sets, ts).select(*df.columns)


def _flagged(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")


def soft_delete(df: DataFrame, keys: DataFrame, key: str, ts: datetime, actor: str) -> DataFrame:
    """Flag the rows whose key is in ``keys``. A row already flagged is stamped again; an empty key set changes nothing."""
    cols, flagged = df.columns, _flagged(df, keys, key)
    sets = {"IsDeleted": F.lit(True), "DeletedDate": at(ts), "DeletedBy": F.lit(actor)}
    return update_where(flagged, F.col("_hit"), sets, ts).select(*cols)


def undelete(df: DataFrame, keys: DataFrame, key: str, ts: datetime, stamp: bool = True) -> DataFrame:
    """Clear the flag and its audit columns; ``stamp=False`` leaves the modification time alone."""
    cols, flagged = df.columns, _flagged(df, keys, key)
    sets = {"IsDeleted": F.lit(False), "DeletedDate": F.lit(None), "DeletedBy": F.lit(None)}
    if not stamp:
        flagged = flagged.withColumn("_original", F.col("ModifiedDate"))
    out = update_where(flagged, F.col("_hit"), sets, ts)
    return (out if stamp else out.withColumn("ModifiedDate", F.col("_original"))).select(*cols)


def purge(tables: dict[str, DataFrame], predicates: dict[str, Column], links: list[tuple[str, str, str]],
          rows: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Remove rows for good. ``links`` lists (child, parent, key) with children first: rows of a child whose parent row
    goes are removed too, however many steps up the condition holds. Each set of doomed keys is found once and stored. ``rows`` are
    the tables to remove from, if those differ from the ones the doomed keys are sought in."""
    doomed: dict[str, DataFrame] = {}

    def condemned(name: str) -> DataFrame | None:
        if name not in doomed:
            df, own = tables[name], schemas.KEYS[name]
            keys = df.filter(predicates[name]).select(own) if name in predicates and own else None
            for child, parent, key in links:
                if child == name and own and condemned(parent) is not None:
                    more = df.join(condemned(parent), key, "left_semi").select(own)
                    keys = more if keys is None else keys.union(more)
            doomed[name] = materialize(keys.distinct(), f"purge-{name}") if keys is not None else None
        return doomed[name]

    out = {}
    for name, df in (rows or tables).items():
        own, kept = schemas.KEYS[name], df
        if own and condemned(name) is not None:
            kept = kept.join(condemned(name), own, "left_anti")
        if not own:
            if name in predicates:
                kept = kept.filter(~F.coalesce(predicates[name], F.lit(False)))
            for child, parent, key in links:
                if child == name and condemned(parent) is not None:
                    kept = kept.join(condemned(parent), key, "left_anti")
        out[name] = kept
    return out


def affected_counts(df: DataFrame, statements: dict[str, Column]) -> DataFrame:
    """Rows each named condition meets, all counted in one pass."""
    counts = df.agg(F.array(*[F.struct(F.lit(n).alias("Statement"), F.count_if(c).alias("AffectedRows"))
                              for n, c in statements.items()]).alias("s"))
    return counts.select(F.inline("s"))


def active_view(df: DataFrame) -> DataFrame:
    return df.filter(is_active()).drop(*schemas.AUDIT_COLUMNS)


def historical(df: DataFrame, kind: str) -> DataFrame:
    """All rows with their record status and how long a closed record lived (``kind`` is Customer or Product)."""
    status = F.when(is_deleted(), "DELETED").otherwise("ACTIVE")
    if kind == "Customer":
        span = F.datediff("DeletedDate", "ModifiedDate").alias("DaysActive")
        return df.select("*", status.alias("RecordStatus"), F.when(is_deleted(), span).alias("DaysActive"))
    span = F.datediff(F.coalesce("SellEndDate", "DeletedDate"), F.col("SellStartDate"))
    return df.select("*", status.alias("RecordStatus"), F.when(is_deleted(), span).alias("ProductLifespanDays"))
