"""One small test per rule in which the source system's arithmetic differs from the engine's."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, map(_kind, values.values())))) \
        if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


def _kind(v):
    return {int: "long", str: "string", float: "double", datetime: "timestamp", bool: "boolean"}[type(v)]


def test_integer_mean_is_cut(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert df.agg(c.avg_int("v")).first()[0] == 1
    assert df.filter("v > 9").agg(c.avg_int("v")).first()[0] is None


@pytest.mark.parametrize("unit,a,b,want", [
    ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:01", 1), ("hour", "2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
    ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1), ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
    ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1), ("second", "2024-01-01 00:00:00", "2024-01-01 00:01:01", 61),
    ("quarter", "2023-12-31 00:00:00", "2024-04-01 00:00:00", 2), ("week", "2024-01-06 00:00:00", "2024-01-07 00:00:00", 1),
    ("week", "2024-01-07 00:00:00", "2024-01-13 00:00:00", 0), ("minute", "2024-01-02 00:00:00", "2024-01-01 00:00:00", -1440)])
def test_boundaries_crossed(spark, unit, a, b, want):
    assert one(spark, c.datediff_sql(unit, c.at(a), c.at(b))) == want


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        c.datediff_sql("fortnight", F.lit(1), F.lit(2))


def test_null_text(spark):
    df = spark.createDataFrame([("A", None, "Z")], "FirstName string, MiddleName string, LastName string")
    row = df.select(c.full_name().alias("n"), F.concat("FirstName", "MiddleName").alias("s"),
                    c.concat_nullable(F.col("FirstName"), F.col("MiddleName")).alias("l")).first()
    assert (row.n, row.s, row.l) == ("A Z", None, "A")


def test_like_case(spark):
    assert one(spark, c.matches_any(F.lit("ABC"), ["%b%"])) is False
    assert one(spark, c.matches_any(F.lit("ABC"), ["%b%"], ci=True)) is True
    assert one(spark, c.matches_any(F.lit("aXc"), ["a_c"])) is True
    assert one(spark, c.matches_any(F.lit("abc"), [])) is False


def test_zero_division_gives_null(spark):
    assert one(spark, c.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, c.int_div(F.lit(1), F.lit(0))) is None
    assert one(spark, c.int_div(F.lit(-7), F.lit(2))) == -3


def test_rounding_half_away(spark):
    assert one(spark, c.format_n0(F.lit(2.5))) == "3"
    assert one(spark, c.format_n0(F.lit(-2.5))) == "-3"
    assert one(spark, c.format_n0(F.lit(1234567.4))) == "1,234,567"
    assert float(one(spark, c.half_up(F.lit(1.005), 2))) == 1.01


def test_month_shift_clamps(spark):
    assert one(spark, c.shift(c.at("2024-03-31"), months=-1)) == datetime(2024, 2, 29)


def test_week_of_year_against_a_day_by_day_count(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2026-12-31')) AS d")
    got = {r.d: r.w for r in days.select("d", c.week_of_year_sql(F.col("d")).alias("w")).collect()}
    week = None
    for d in sorted(got):
        week = 1 if (d.month, d.day) == (1, 1) else week + (d.weekday() == 6)
        assert got[d] == week, d


def test_fiscal_year(spark):
    assert one(spark, c.fiscal_year(F.lit("2024-07-01").cast("date"))) == 2025
    assert one(spark, c.fiscal_year(F.lit("2024-06-30").cast("date"))) == 2024


def test_flags(spark):
    df = spark.createDataFrame([(None,), (0,), (1,)], "IsDeleted int")
    assert [r[0] for r in df.select(c.is_active()).collect()] == [True, True, False]
    assert df.filter(c.flag_is("IsDeleted", False)).count() == 1


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("x",)], "e string")
    assert [r[0] for r in df.select(c.is_blank("e")).collect()] == [True, True, True, False]


def test_band_order_and_nulls(spark):
    df = spark.createDataFrame([(10,), (5,), (1,), (None,)], "v int")
    assert [r[0] for r in df.select(c.band("v", [(10, "a"), (5, "b")], "z")).collect()] == ["a", "b", "z", "z"]
    assert [r[0] for r in df.select(c.band("v", [(5, "lo")], "hi", op="<=")).collect()] == ["hi", "lo", "lo", "hi"]


def test_growth_needs_positive_base(spark):
    assert one(spark, c.pct_change(F.lit(5), F.lit(0))) is None
    assert float(one(spark, c.pct_change(F.lit(15), F.lit(10)))) == 50.0


def test_now_is_folded_into_the_scan(spark):
    from conftest import DATA
    from tidemark.sources.tables import load_mirror
    orders = load_mirror(spark, DATA)["SalesOrderHeader"]
    df = orders.filter(F.col("OrderDate") >= c.shift(c.at(datetime(2001, 8, 2)), days=-30)).select("SalesOrderID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2001-07-03" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp>" in plan


