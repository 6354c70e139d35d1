"""Named queries over a folder of parquet tables, with plain result types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ORDERS_AS_OF, TEST_THRESHOLDS
from tidemark.plans import bi, mirror_queries, primitives, views
from tidemark.sources.tables import load_mirror

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Decimals to doubles of two places, whole numbers and flags to bigint, dates to timestamps."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = F.round(c, 2).cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("timestamp")
        out.append(c.alias(field.name))
    return df.select(*out)


def over_tables(build: Callable, **options) -> Query:
    """A view or report over the mirrored tables at the fixed test time and thresholds."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(load_mirror(spark, folder), ORDERS_AS_OF, TEST_THRESHOLDS, **options))
    return run


def with_tables(build: Callable) -> Query:
    """As ``over_tables`` for builders that take the tables and the time only."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(load_mirror(spark, folder), ORDERS_AS_OF))
    return run


VIEW_QUERIES: dict[str, Query] = {
    "customer_360": over_tables(views.customer_360),
    "customer_summary": over_tables(views.customer_summary),
    "customer_ltv": over_tables(views.customer_ltv),
    "product_performance": over_tables(views.product_performance),
    "product_performance_active": over_tables(views.product_performance, active_only=True),
    "product_performance_by_count": over_tables(views.product_performance_by_count),
    "category_performance": over_tables(views.category_performance),
    "category_performance_corrected": over_tables(views.category_performance, fanout="corrected"),
    "sales_trend": over_tables(views.sales_trend),
    "sales_trend_corrected": over_tables(views.sales_trend, fanout="corrected"),
    "sales_trend_short": over_tables(views.sales_trend_short),
    "order_analysis": over_tables(views.order_analysis),
    "data_quality": over_tables(views.data_quality),
    "view_catalog": over_tables(views.view_catalog_status),
    "business_kpi": over_tables(views.business_kpi),
}

REPORT_QUERIES: dict[str, Query] = {
    "exec_kpi": over_tables(bi.exec_kpi),
    "monthly_revenue_trend": over_tables(bi.monthly_revenue_trend),
    "monthly_revenue_trend_corrected": over_tables(bi.monthly_revenue_trend, fanout="corrected"),
    "segment_overview": over_tables(bi.segment_overview),
    "top_customers": over_tables(bi.top_customers),
    "rfm_base": with_tables(bi.rfm_base),
    "rfm_segments": over_tables(bi.rfm_segments),
    "product_overview": over_tables(bi.product_overview),
    "category_analysis": over_tables(bi.category_analysis),
    "category_analysis_corrected": over_tables(bi.category_analysis, fanout="corrected"),
    "top_products_by_category": over_tables(bi.top_products_by_category),
    "portfolio": over_tables(bi.portfolio),
    "sales_performance": over_tables(bi.sales_performance),
    "sales_performance_corrected": over_tables(bi.sales_performance, fanout="corrected"),
    "order_status": over_tables(bi.order_status_report),
    "daily_sales": over_tables(bi.daily_sales),
    "daily_sales_corrected": over_tables(bi.daily_sales, fanout="corrected"),
    "channel_performance": over_tables(bi.channel_performance),
    "channel_performance_corrected": over_tables(bi.channel_performance, fanout="corrected"),
    "dq_scores": over_tables(bi.dq_scores),
    "business_summary": over_tables(bi.business_summary),
    "cohort_base": with_tables(bi.cohort_base),
    "cohort_retention": over_tables(bi.cohort_retention),
    "cohort_matrix": with_tables(bi.cohort_matrix),
    "measure_growth": over_tables(bi.measure_growth),
    "measure_retention": over_tables(bi.measure_retention),
    "measure_ship_days": over_tables(bi.measure_ship_days),
    "category_breakdown": over_tables(bi.category_breakdown),
    "customer_spend": over_tables(bi.customer_spend),
    "order_headers": over_tables(bi.order_headers),
    "order_lines": over_tables(bi.order_lines),
    "order_rollup": over_tables(bi.order_rollup),
    "price_margin": over_tables(bi.price_margin),
    "product_lifecycle": over_tables(bi.product_lifecycle),
    "customer_retention": over_tables(bi.customer_retention),
    "orders_of_deleted_customers": over_tables(bi.orders_of_deleted_customers),
    "date_dim": with_tables(bi.calendar_orders),
}


def over_folder(build: Query) -> Query:
    return lambda spark, folder: present(build(spark, folder))


MIRROR_QUERIES: dict[str, Query] = {
    **{name: with_tables(build) for name, build in mirror_queries.TABLE_QUERIES.items()},
    **{name: over_folder(build) for name, build in mirror_queries.FOLDER_QUERIES.items()},
}

PRIMITIVE_QUERIES: dict[str, Query] = {name: with_tables(build) for name, build in primitives.PRIMITIVES.items()}

QUERIES: dict[str, Query] = {**VIEW_QUERIES, **REPORT_QUERIES, **MIRROR_QUERIES, **PRIMITIVE_QUERIES}
