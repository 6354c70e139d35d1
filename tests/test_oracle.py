"""Every query against its SQL on a second engine, exact values."""

import pytest
from conftest import DATA
from oracle import compare, connect

import __spark_entry__ as entry
from tidemark.oracle import sql_by_name
from tidemark.registry import QUERIES

SQL = sql_by_name()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    assert compare(entry.queries()[name](spark, DATA), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_kpi_decomposition_equals_literal_product(spark, con):
    """The decomposed KPI sums against the table product itself, row by row."""
    from tidemark.oracle.base import DUE, mirror_sql
    literal = mirror_sql(f"""
      SELECT round(sum({DUE}), 2)::DOUBLE AS total, count(DISTINCT c.CustomerID) AS people, count(DISTINCT p.ProductID) AS goods,
        round(sum(CASE WHEN o.OrderDate >= TIMESTAMP '2001-07-03' AND NOT o.IsDeleted THEN {DUE} ELSE 0 END), 2)::DOUBLE AS recent
      FROM m_customer c FULL JOIN m_order o ON c.CustomerID = o.CustomerID CROSS JOIN m_product p""")
    total, people, goods, recent = con.sql(literal).fetchall()[0]
    row = QUERIES["business_kpi"](spark, DATA).first()
    assert (row.TotalRevenue, row.TotalCustomers, row.TotalProducts, row.Revenue_Last30Days) == (total, people, goods, recent)
