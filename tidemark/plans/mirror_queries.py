"""The change, stream, audit and monitoring operators applied to the mirrored tables and their change log."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import EVENTS_AS_OF, ORDERS_AS_OF, shared_dir
from tidemark.functions.columns import at, is_active, is_deleted, percent, shift
from tidemark.operators import audit, changes, monitor, softdelete
from tidemark.sources.tables import (
    Tables, catalog_scan, load_changes, load_mirror, read_evolving, read_raw, register_raw, stream_changes, stream_events,
)
from tidemark.streaming import cdc, dedupe, observed, versions, windows

PAYLOAD = ["set_value", "set_props"]
LINKS = [("SalesOrderDetail", "SalesOrderHeader", "SalesOrderID"), ("SalesOrderDetail", "Product", "ProductID"),
         ("SalesOrderHeader", "Customer", "CustomerID"), ("CustomerAddress", "Customer", "CustomerID")]
MONTH_HOURS = 24 * 30


def money(text: str) -> Column:
    return F.lit(Decimal(text))


# --- edits ----------------------------------------------------------------------------------------------------------

def reopened(tables: Tables) -> DataFrame:
    """Closed customers applying again, as new rows without a key."""
    return (tables["Customer"].filter(is_deleted())
            .select("CustomerID", "Title", F.lit("Reopened").alias("FirstName"), "MiddleName", "LastName", "CompanyName",
                    "EmailAddress", "Phone"))


def assign_keys(tables: Tables, as_of: datetime) -> DataFrame:
    return changes.assign_keys(reopened(tables), tables["Customer"], "CustomerID", "LastName").select(
        "CustomerID", "LastName")


def insert_rows(tables: Tables, as_of: datetime) -> DataFrame:
    new = changes.assign_keys(reopened(tables), tables["Customer"], "CustomerID", "LastName")
    return changes.insert_rows(tables["Customer"], new, as_of)


def update_by_key(tables: Tables, as_of: datetime) -> DataFrame:
    """Seasonal price cut and rename of one colour."""
    out = changes.update_where(tables["Product"], F.col("Color") == "Black", {
        "ListPrice": F.col("ListPrice") * money("0.75"), "Name": F.concat("Name", F.lit(" sale"))}, as_of)
    return out.select("ProductID", "Name", "ListPrice", "StandardCost", "IsDeleted", "ModifiedDate")


def bulk_update(tables: Tables, as_of: datetime) -> DataFrame:
    """New due dates by ship method for orders neither cancelled nor shipped."""
    now, method = at(as_of), F.col("ShipMethod")
    due = (F.when(method == "EXPEDITED", shift(now, days=3)).when(method == "STANDARD GROUND", shift(now, days=7))
           .when(method == "TRUCK GROUND", shift(now, days=10)).otherwise(shift(now, days=5)))
    out = changes.update_where(tables["SalesOrderHeader"], ~F.col("Status").isin(5, 6), {"DueDate": due}, as_of)
    return out.select("SalesOrderID", "Status", "ShipMethod", "DueDate", "ModifiedDate")


def update_from(tables: Tables, as_of: datetime) -> DataFrame:
    """Cost factors by category name."""
    name = F.col("_dim_Name")
    factor = (F.when(name == "LARGE", money("0.95")).when(name == "SMALL", money("1.02"))
              .when(name == "PROMO", money("0.98")).otherwise(money("1.00")))
    out = changes.update_from(tables["Product"], tables["ProductCategory"], "ProductCategoryID",
                              {"StandardCost": F.col("StandardCost") * factor}, as_of)
    return out.select("ProductID", "ProductCategoryID", "StandardCost", "ListPrice", "ModifiedDate")


def dormant(tables: Tables) -> DataFrame:
    """Customers without a live order in the current year."""
    busy = tables["SalesOrderHeader"].filter(is_active() & (F.col("OrderDate") >= "2001-01-01"))
    return tables["Customer"].select("CustomerID").join(busy.select("CustomerID").distinct(), "CustomerID", "left_anti")


_AUDIT = ["IsDeleted", "DeletedDate", "DeletedBy", "ModifiedDate"]


def soft_delete(tables: Tables, as_of: datetime) -> DataFrame:
    return changes.soft_delete(tables["Customer"], dormant(tables), "CustomerID", as_of, "auditor").select(
        "CustomerID", *_AUDIT)


def bulk_soft_delete(tables: Tables, as_of: datetime) -> DataFrame:
    free = tables["Product"].filter(F.col("StandardCost") == 0).select("ProductID")
    return changes.soft_delete(tables["Product"], free, "ProductID", as_of, "auditor").select("ProductID", *_AUDIT)


def undelete(tables: Tables, as_of: datetime) -> DataFrame:
    """Restore closed customers who still ordered lately."""
    back = (tables["SalesOrderHeader"].filter(is_active() & (F.col("OrderDate") >= "2001-06-01"))
            .join(tables["Customer"].filter(is_deleted()).select("CustomerID"), "CustomerID", "left_semi"))
    return changes.undelete(tables["Customer"], back, "CustomerID", as_of).select("CustomerID", *_AUDIT)


def purge_rules() -> dict[str, Column]:
    return {"Product": F.col("Name").like("%bolt%"),
            "SalesOrderHeader": is_deleted() & (F.col("ShipMethod") == "EXPEDITED"),
            "Customer": F.col("EmailAddress") == ""}


def purged(tables: Tables) -> Tables:
    return changes.purge(tables, purge_rules(), LINKS)


def purge_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows every statement of a purge removed, observed while the kept rows were written."""
    return observed.purge_counted(spark, load_mirror(spark, folder), purge_rules(), LINKS, shared_dir(spark, "purged"))


def purge(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.row_count_integrity(tables, purged(tables))


ROW_NAMES = {"Customer": ["CustomerID"], "Product": ["ProductID"], "ProductCategory": ["ProductCategoryID"], "ProductModel": ["ProductModelID"],
             "SalesOrderHeader": ["SalesOrderID"], "SalesOrderDetail": ["SalesOrderID", "ProductID", "OrderQty"], "CustomerAddress": ["CustomerID", "AddressType"]}


def purge_rows(tables: Tables, as_of: datetime) -> DataFrame:
    """The rows a purge keeps, by name."""
    parts = [df.select(F.lit(name).alias("TableName"), F.concat_ws("|", *[F.col(c).cast("string") for c in ROW_NAMES[name]]).alias("RowName"))
             for name, df in purged(tables).items()]
    return reduce(DataFrame.union, parts)


def affected_counts(tables: Tables, as_of: datetime) -> DataFrame:
    return changes.affected_counts(tables["SalesOrderHeader"], {
        "cancel_expedited": is_deleted() & (F.col("ShipMethod") == "EXPEDITED"),
        "reschedule_open": ~F.col("Status").isin(5, 6), "restore_shipped": is_deleted() & (F.col("Status") == 5)})


def with_audit_columns(tables: Tables, as_of: datetime) -> DataFrame:
    return changes.with_audit_columns(tables["CustomerAddress"])


def active_rows(name: str):
    return lambda tables, as_of: changes.active_view(tables[name])


def historical_rows(name: str):
    return lambda tables, as_of: changes.historical(tables[name], name)


def soft_delete_summary(tables: Tables, as_of: datetime) -> DataFrame:
    return softdelete.soft_delete_summary(tables)


def recently_deleted(tables: Tables, as_of: datetime) -> DataFrame:
    return softdelete.recently_deleted(tables, as_of, MONTH_HOURS)


def preserved_value(tables: Tables, as_of: datetime) -> DataFrame:
    return softdelete.preserved_value(tables, as_of, MONTH_HOURS)


def update_impact(tables: Tables, as_of: datetime) -> DataFrame:
    return softdelete.update_impact(tables, as_of, MONTH_HOURS * 60)


# --- change feed ----------------------------------------------------------------------------------------------------

def cdc_fold(spark: SparkSession, folder: str) -> DataFrame:
    log = load_changes(spark, folder)
    return changes.current_rows(changes.fold_changes(log, PAYLOAD), PAYLOAD)


def cdc_apply(spark: SparkSession, folder: str) -> DataFrame:
    """The feed streamed into a change store, then read back."""
    feed = stream_changes(spark, folder)
    store = cdc.ChangeStore(spark, shared_dir(spark, "cdc-state"), feed.schema, PAYLOAD)
    cdc.start_cdc(feed, store, shared_dir(spark, "cdc-checkpoint")).awaitTermination()
    return store.current()


def middle_of(log: DataFrame) -> int:
    return log.agg(F.floor((F.min("seq") + F.max("seq")) / 2)).first()[0] or 0


def cdc_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The state before the middle of the log as snapshots of the single tables, the later changes streamed on top, a
    compaction between, and one after."""
    log = load_changes(spark, folder)
    middle = middle_of(log)
    old = changes.current_rows(changes.fold_changes(log.filter(F.col("seq") <= middle), PAYLOAD), PAYLOAD)
    feed = stream_changes(spark, folder)
    store = cdc.ChangeStore(spark, shared_dir(spark, "cdc-state"), feed.schema, PAYLOAD)
    for name in ("Customer", "Product", "SalesOrderHeader"):
        store.seed(old.filter(F.col("table_name") == name), EVENTS_AS_OF, "IsDeleted", name, "LastSeq")
    store.compact()
    cdc.start_cdc(feed.filter(F.col("seq") > middle), store, shared_dir(spark, "cdc-checkpoint")).awaitTermination()
    store.compact()
    return store.current()


def with_purges(log: DataFrame) -> DataFrame:
    """A feed in which some deletes remove their row for good."""
    return log.withColumn("op", F.when((F.col("op") == "D") & (F.col("seq") % 4 == 0), "P").otherwise(F.col("op")))


def cdc_purge(spark: SparkSession, folder: str) -> DataFrame:
    """Hard deletes through the feed: the later half arrives first, is compacted, and then the earlier half comes."""
    log = with_purges(load_changes(spark, folder))
    middle = middle_of(log)
    feed = with_purges(stream_changes(spark, folder))
    store = cdc.ChangeStore(spark, shared_dir(spark, "cdc-state"), feed.schema, PAYLOAD)
    for part in (F.col("seq") > middle, F.col("seq") <= middle):
        cdc.start_cdc(feed.filter(part), store, shared_dir(spark, "cdc-checkpoint")).awaitTermination()
        store.compact()
    return store.current()


def cdc_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """A feed whose second column exists only from the middle of the log on, read back with both."""
    log = load_changes(spark, folder)
    middle, where = middle_of(log), shared_dir(spark, "cdc-state")
    narrow = log.drop("set_props")
    store = cdc.ChangeStore(spark, where, narrow.schema, ["set_value"])
    store.apply(narrow.filter(F.col("seq") <= middle), 0)
    cdc.ChangeStore(spark, where, log.schema, PAYLOAD).apply(log.filter(F.col("seq") > middle), 1)
    return store.evolved().current()


def evolved_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of which some were written before the phone and the audit columns existed."""
    people, root = load_mirror(spark, folder)["Customer"], shared_dir(spark, "evolving")
    old = F.col("CustomerID") % 2 == 0
    people.filter(old).drop("Phone", "IsDeleted", "DeletedDate", "DeletedBy").write.parquet(f"{root}/written=1")
    people.filter(~old).write.parquet(f"{root}/written=2")
    both = changes.with_audit_columns(read_evolving(spark, root))
    return both.select("CustomerID", "LastName", "Phone", "ModifiedDate", F.coalesce("IsDeleted", F.lit(False)).alias("IsDeleted"), "DeletedDate", "DeletedBy")


def streamed(spark: SparkSession, stream: DataFrame, part, name: str) -> DataFrame:
    """Parts of all micro-batches of a stream that is read to its present end."""
    folders = cdc.BatchFolders(spark, shared_dir(spark, name), part(stream).schema)
    cdc.append_batches(stream, folders, shared_dir(spark, f"{name}-checkpoint"), part).awaitTermination()
    return folders.read()


def feed_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that delivered its updates twice, each change kept once, counted per table and kind."""
    log = load_changes(spark, folder)
    twice = log.union(log.filter(F.col("op") == "U"))
    return changes.dedupe_feed(twice).groupBy("table_name", "op").agg(F.count("*").alias("Changes"))


def feed_dedupe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream: each batch keeps its distinct changes, the reader those of all batches."""
    feed = stream_changes(spark, folder).select("table_name", "key", "seq", "op")
    twice = feed.withColumn("copy", F.explode(F.when(F.col("op") == "U", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy")
    kept = streamed(spark, twice, lambda batch: batch.dropDuplicates(["table_name", "key", "seq"]), "feed-dedupe")
    return changes.dedupe_feed(kept).groupBy("table_name", "op").agg(F.count("*").alias("Changes"))


def late_dedupe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A feed in three deliveries, each spread over all time and with its updates twice, deduplicated in state that spans an hour:
    what came too late for it is added back. The stream starts again for each delivery."""
    log, root = load_changes(spark, folder), shared_dir(spark, "deliveries")
    checkpoint = shared_dir(spark, "deliveries-checkpoint")
    feed = dedupe.DedupedFeed(spark, shared_dir(spark, "deduped"), log.schema)
    for delivery in range(3):
        part = log.filter(F.pmod("seq", F.lit(3)) == delivery)
        part.union(part.filter(F.col("op") == "U")).write.parquet(f"{root}/delivery-{delivery}")
        feed.start(spark.readStream.schema(log.schema).parquet(f"{root}/delivery-*"), checkpoint).awaitTermination()
    return feed.whole().groupBy("table_name", "op").agg(F.count("*").alias("Changes"))


def feed_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Changes by kind as each micro-batch of the store's feed observed them, added up."""
    kinds = {"Inserts": "I", "Updates": "U", "Deletes": "D", "Restores": "R"}
    feed = stream_changes(spark, folder)
    store = cdc.ChangeStore(spark, shared_dir(spark, "cdc-state"), feed.schema, PAYLOAD)
    listener = observed.BatchCounts("feed")
    spark.streams.addListener(listener)
    try:
        counted = observed.watched(feed, "feed", {label: F.col("op") == op for label, op in kinds.items()})
        batches = observed.drain(cdc.start_cdc(counted, store, shared_dir(spark, "cdc-checkpoint")), listener)
    finally:
        spark.streams.removeListener(listener)
    rows = [(batch, *[seen[k] for k in kinds]) for batch, seen in sorted(batches.items())]
    per_batch = spark.createDataFrame(rows, "batch long, Inserts long, Updates long, Deletes long, Restores long")
    return per_batch.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds])


def history_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """History kept up to date over three batches that arrive out of order, one of them twice."""
    log = load_changes(spark, folder)
    store = versions.HistoryStore(spark, shared_dir(spark, "history"), log.schema, PAYLOAD)
    for number, part in enumerate((2, 0, 2, 1)):
        store.apply(log.filter(F.pmod(F.floor(F.col("seq") / 7), F.lit(3)) == part), number)
    return store.history()


def arrivals(log: DataFrame) -> DataFrame:
    """The log with an arrival time up to 96 minutes after the change."""
    return log.withColumn("arrived", F.col("ts") + F.make_dt_interval(mins=(F.col("seq") % 97).cast("int")))


def change_counts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.change_counts(load_changes(spark, folder))


def change_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The windowed counts from a stream; no row is too late for them."""
    return windows.count_whole(streamed(spark, stream_changes(spark, folder), windows.count_part, "change-counts"))


def late_changes(spark: SparkSession, folder: str) -> DataFrame:
    return windows.late_changes(arrivals(load_changes(spark, folder)))


def late_changes_stream(spark: SparkSession, folder: str) -> DataFrame:
    return windows.late_whole(streamed(spark, arrivals(stream_changes(spark, folder)), windows.late_part, "late-changes"))


def replication_lag(spark: SparkSession, folder: str) -> DataFrame:
    return windows.replication_lag(arrivals(load_changes(spark, folder)))


def history(spark: SparkSession, folder: str) -> DataFrame:
    return changes.history(load_changes(spark, folder), PAYLOAD)


def price_history(spark: SparkSession, folder: str) -> DataFrame:
    return changes.price_history(load_changes(spark, folder))


def found_sessions(spark: SparkSession, folder: str, gap_minutes: int) -> DataFrame:
    return windows.sessions(read_raw(spark, folder, "events"), EVENTS_AS_OF, gap_minutes,
                            is_error=F.col("event_type") == "error")


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    return found_sessions(spark, folder, 240)


def session_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions from a stream of events: slots per batch, sessions over the slots of all batches."""
    def part(batch: DataFrame) -> DataFrame:
        return windows.session_part(batch, 240, is_error=F.col("event_type") == "error")

    return windows.session_whole(streamed(spark, stream_events(spark, folder), part, "session-slots"), EVENTS_AS_OF, 240)


# --- audits ---------------------------------------------------------------------------------------------------------

def profile_columns(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.profile_columns(tables)


def type_proposals(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.type_proposals(tables)


def convert_types(tables: Tables, as_of: datetime) -> DataFrame:
    """Values that do not convert to a narrower type, per column."""
    texts = tables["Customer"].select("EmailAddress", "Phone", "MiddleName", "LastName")
    return audit.convert(texts, {"EmailAddress": "int", "Phone": "int", "MiddleName": "boolean", "LastName": "bigint"})[1]


NARROW = {"LastName": "bigint", "Phone": "int", "MiddleName": "boolean"}


def quarantined(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers to narrower types: digits behind the area code as numbers, short company names."""
    people = tables["Customer"].withColumn("Phone", F.when(F.col("CustomerID") % 5 != 0, F.substring("Phone", 5, 12)).otherwise(F.col("Phone")))
    return audit.quarantine(people.select("CustomerID", "LastName", "Phone", "MiddleName", "CompanyName"), ["CustomerID"], NARROW, {"CompanyName": 12})


def converted_rows(tables: Tables, as_of: datetime) -> DataFrame:
    return quarantined(tables)[0]


def rejected_values(tables: Tables, as_of: datetime) -> DataFrame:
    return quarantined(tables)[1]


def conformance(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.conformance(tables)


def key_audits(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.key_audits(tables)


def backfill(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.backfill(tables["Customer"], {"Title": "n/a", "IsDeleted": False, "Phone": ""}).select(
        "CustomerID", "Title", "IsDeleted", "Phone")


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("html", T.StringType())])


def truncate_binary(spark: SparkSession, folder: str, limit: int = 1 << 20) -> DataFrame:
    pages = spark.read.schema(PAGES).parquet(f"{folder}/pages.parquet")
    cut = audit.truncate_binary(pages.select("page_id", F.col("html").cast("binary").alias("body")), "body", limit)
    return cut.select("page_id", "OriginalBytes", F.octet_length("body").alias("KeptBytes"), F.md5("body").alias("KeptHash"), "Truncated")


def truncate_binary_small(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a limit that most pages exceed."""
    return truncate_binary(spark, folder, 2048)


def issue_summary(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.issue_summary(tables)


def row_count_integrity(tables: Tables, as_of: datetime) -> DataFrame:
    """Counts before and after converting the text key of customers and dropping rejected nothing."""
    converted = dict(tables)
    converted["Customer"] = audit.convert(tables["Customer"], {"LastName": "bigint", "Phone": "int"})[0]
    converted["SalesOrderHeader"] = changes.active_view(tables["SalesOrderHeader"])
    return audit.row_count_integrity(tables, converted)


def reconcile_header_detail(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.reconcile_header_detail(tables)


def referential(tables: Tables, as_of: datetime) -> DataFrame:
    return audit.referential(tables)


def find_records(tables: Tables, as_of: datetime) -> DataFrame:
    rules = {
        "Customer": audit.pattern_rule({"EmailAddress": ["c1%@example.com", "%99@%"], "CompanyName": ["%BUILD%"]},
                                       {"FirstName": ["SoftDelete"]}),
        "Product": audit.pattern_rule({"Name": ["%bolt%", "small %"], "ProductNumber": ["P-%7"]},
                                      {"Color": ["Silver"]}),
        "SalesOrderHeader": audit.pattern_rule({"PurchaseOrderNumber": ["PO-1__"], "AccountNumber": ["acc-7%"]}, ci=True),
    }
    return audit.find_records(tables, rules)


# --- monitoring -----------------------------------------------------------------------------------------------------

def freshness(tables: Tables, as_of: datetime) -> DataFrame:
    return monitor.freshness(tables, as_of)


def lagging_mirror(tables: Tables) -> Tables:
    """A mirror out of step: customers without phone missing, e-mails rewritten, some rows too many, deleted orders
    lost, small order lines lost and large ones doubled, product models and addresses not mirrored."""
    people = tables["Customer"]
    extra = people.filter(F.col("Title").isNotNull()).withColumn("CustomerID", F.col("CustomerID") + 1_000_000_000_000)
    kept = people.filter(F.col("Phone").isNotNull()).withColumn("EmailAddress", F.coalesce("EmailAddress", F.lit("")))
    lines = tables["SalesOrderDetail"]
    return {"Customer": kept.union(extra), "Product": tables["Product"], "ProductCategory": tables["ProductCategory"],
            "SalesOrderHeader": tables["SalesOrderHeader"].filter(is_active()),
            "SalesOrderDetail": lines.filter(F.col("OrderQty") > 2).union(lines.filter(F.col("OrderQty") == 50))}


def reconcile(tables: Tables, as_of: datetime) -> DataFrame:
    return monitor.reconcile_all(tables, lagging_mirror(tables))


def reconcile_rows(tables: Tables, as_of: datetime) -> DataFrame:
    return monitor.reconcile_rows(tables, lagging_mirror(tables))


def failing_items(tables: Tables, as_of: datetime) -> DataFrame:
    return monitor.failing_items(reconcile(tables, as_of))


def catalog_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Columns, types, row and null counts of the tables the catalogue lists."""
    names = ["customer", "part", "orders", "lineitem", "events"]
    register_raw(spark, folder, names, "listed_")
    return catalog_scan(spark, "listed_")


def change_activity(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.change_activity(load_changes(spark, folder), load_mirror(spark, folder), EVENTS_AS_OF)


def activity_levels(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_mirror(spark, folder)
    return monitor.activity_levels(load_changes(spark, folder), tables, list(lagging_mirror(tables)), EVENTS_AS_OF, 24)


METRICS = {"click": "cpu_percent", "view": "data_io_percent", "purchase": "log_write_percent", "signup": "memory_percent"}


def metric_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.metric_rollup(read_raw(spark, folder, "events"), EVENTS_AS_OF, METRICS, hours=24)


def band_durations(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.band_durations(sessions(spark, folder), EVENTS_AS_OF)


def session_activity(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.session_activity(sessions(spark, folder), EVENTS_AS_OF, hours=48)


def error_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.error_sessions(sessions(spark, folder))


def _usage(events: DataFrame, by: list[str]) -> DataFrame:
    x = F.col("value").cast("decimal(18,2)")
    return events.groupBy(*by).agg(
        F.sum(F.when(F.col("event_type").isin("click", "view", "purchase"), x)).alias("UsedSpace"),
        F.sum(x).alias("TotalSpace"))


def usage_bands(spark: SparkSession, folder: str) -> DataFrame:
    events = read_raw(spark, folder, "events")
    return monitor.usage_bands(_usage(events, ["user_id"]), F.col("UsedSpace"), F.col("TotalSpace"))


def wait_chains(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.wait_chains(read_raw(spark, folder, "events"))


def known_facts(spark: SparkSession, folder: str) -> DataFrame:
    events = read_raw(spark, folder, "events")
    capacity = _usage(events, []).select(percent(F.col("UsedSpace"), F.col("TotalSpace"))).scalar()
    return monitor.facts(reconcile(load_mirror(spark, folder), ORDERS_AS_OF), sessions(spark, folder),
                         wait_chains(spark, folder), capacity, EVENTS_AS_OF)


def health_score(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.health_score(known_facts(spark, folder))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.alerts(known_facts(spark, folder))


TABLE_QUERIES = {
    "insert_rows": insert_rows, "assign_keys": assign_keys, "update_by_key": update_by_key, "bulk_update": bulk_update,
    "update_from": update_from, "soft_delete": soft_delete, "bulk_soft_delete": bulk_soft_delete, "undelete": undelete,
    "purge": purge, "purge_rows": purge_rows, "affected_counts": affected_counts, "with_audit_columns": with_audit_columns,
    "active_customers": active_rows("Customer"), "active_products": active_rows("Product"),
    "active_orders": active_rows("SalesOrderHeader"), "historical_customers": historical_rows("Customer"),
    "historical_products": historical_rows("Product"), "soft_delete_summary": soft_delete_summary,
    "recently_deleted": recently_deleted, "preserved_value": preserved_value, "update_impact": update_impact,
    "profile_columns": profile_columns, "type_proposals": type_proposals, "convert_types": convert_types,
    "conformance": conformance, "key_audit": key_audits, "backfill": backfill, "issue_summary": issue_summary,
    "row_count_integrity": row_count_integrity, "reconcile_header_detail": reconcile_header_detail,
    "referential": referential, "find_records": find_records, "freshness": freshness, "reconcile": reconcile,
    "failing_items": failing_items, "reconcile_rows": reconcile_rows, "converted_rows": converted_rows, "rejected_values": rejected_values,
}
FOLDER_QUERIES = {
    "catalog_inventory": catalog_inventory,
    "late_dedupe_stream": late_dedupe_stream, "cdc_purge": cdc_purge, "cdc_evolve": cdc_evolve, "evolved_rows": evolved_rows,
    "history_incremental": history_incremental, "purge_counts": purge_counts, "feed_counts_stream": feed_counts_stream,
    "cdc_fold": cdc_fold, "cdc_apply": cdc_apply, "cdc_snapshot": cdc_snapshot, "feed_dedupe_stream": feed_dedupe_stream,
    "late_changes_stream": late_changes_stream, "session_stream": session_stream, "truncate_binary_small": truncate_binary_small, "feed_dedupe": feed_dedupe, "change_counts": change_counts,
    "change_counts_stream": change_counts_stream, "late_changes": late_changes, "replication_lag": replication_lag,
    "history": history, "price_history": price_history, "sessions": sessions, "truncate_binary": truncate_binary,
    "change_activity": change_activity, "activity_levels": activity_levels, "metric_rollup": metric_rollup,
    "band_durations": band_durations, "session_activity": session_activity, "error_sessions": error_sessions,
    "usage_bands": usage_bands, "wait_chains": wait_chains, "health_score": health_score, "alerts": alerts,
}
