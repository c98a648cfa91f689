"""Registered queries: name, Spark plan and, where SQL can say it, the comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans.bindings import SALES, sales_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
COMPARISON_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(plan: Query) -> Query:
        QUERIES[plan.__name__] = plan
        if sql is not None:
            COMPARISON_SQL[plan.__name__] = sql
        return plan

    return register


def _exact_division(sql: str) -> str:
    """DuckDB divides decimals as doubles; say the half-up quotient in whole numbers instead."""
    quotient = SALES["avg_sell_price"][0]
    amount, quantity = SALES["sales_amount_rub"][0], SALES["sales_quantity"][0]
    whole = f"((cast({amount} * 100 as bigint) * 200 + {quantity}) // (2 * {quantity}))"
    exact = f"cast(cast({whole} as decimal(18,0)) * cast(0.0001 as decimal(5,4)) as decimal(18,4))"
    return sql.replace(quotient, exact)


def sales_cte(*fields: str, binding=SALES, name: str = "sales") -> str:
    """``name as (...)`` over the given tables, for comparison SQL."""
    return f"{name} as ({_exact_division(sales_sql(fields, binding))})"
