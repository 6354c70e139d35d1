"""Shared pieces of the reference SQL that checks every query on a second engine."""

from __future__ import annotations

import re

from tidemark.sources.mapping import CHANGE, MIRROR

NOW = "TIMESTAMP '2001-08-02'"
ENOW = "TIMESTAMP '2024-01-31'"

_VIEW = {
    "m_customer": "Customer", "m_product": "Product", "m_category": "ProductCategory", "m_model": "ProductModel",
    "m_order": "SalesOrderHeader", "m_line": "SalesOrderDetail", "m_address": "CustomerAddress",
}


def _select(view: str) -> str:
    if view == "m_change":
        return f"SELECT {', '.join(CHANGE)} FROM events"
    raw, exprs, distinct = MIRROR[_VIEW[view]]
    return f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(exprs)} FROM {raw}"


def mirror_sql(body: str, **parts: str) -> str:
    """Prefix ``body`` with the mirrored tables it names and with the given named subqueries."""
    text = body + " ".join(parts.values())
    used = [v for v in [*_VIEW, "m_change"] if re.search(rf"\b{v}\b", text)]
    ctes = [f"{v} AS ({_select(v)})" for v in used] + [f"{k} AS ({v})" for k, v in parts.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def usd(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def ts(x: str) -> str:
    return f"CAST({x} AS TIMESTAMP)"


def rnd(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def avg(x: str) -> str:
    return div(f"sum({x})", f"count({x})")


def avgi(x: str) -> str:
    return f"CAST(sum({x}) // nullif(count({x}), 0) AS BIGINT)"


def pct(a: str, b: str, n: int = 2) -> str:
    return rnd(f"{div(a, b)} * 100", n)


def growth(a: str, b: str, n: int = 2) -> str:
    return f"CASE WHEN {b} > 0 THEN {pct(f'({a} - {b})', b, n)} END"


def dd(a: str, b: str, unit: str = "day") -> str:
    return f"CAST(date_diff('{unit}', {a}, {b}) AS BIGINT)"


LIVE = "NOT coalesce({0}.IsDeleted, FALSE)"
GONE = "coalesce({0}.IsDeleted, FALSE)"


def live(a: str) -> str:
    return LIVE.format(a)


def gone(a: str) -> str:
    return GONE.format(a)


DUE = "(o.SubTotal + o.TaxAmt + o.Freight)"
LINE = "(l.OrderQty * l.UnitPrice * (1 - l.UnitPriceDiscount))"
MARGIN = f"(CASE WHEN p.StandardCost > 0 THEN {div('(p.ListPrice - p.StandardCost)', 'p.StandardCost')} * 100 ELSE 0.0::DOUBLE END)"
