"""Denormalise a star schema: one fact, six dimensions, three of them reached in a second role."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame

from ..contract import SALES, Contract
from .columns import drop_suffix
from .joins import broadcast_if_small, left_join, renamed_role

DATE_PARTS = ("year", "month", "day", "weekday", "quarter")


def join_dimensions(fact: DataFrame, dims: Mapping[str, DataFrame], salted: Collection[str] = ()) -> DataFrame:
    """Left join each dimension on its surrogate key (``{key column: dimension}``).

    ``salted`` names the keys whose hot values are spread by salting.
    """
    for key, dim in dims.items():
        fact = left_join(fact, dim, key, salted=key in salted)
    return fact


def join_store_manager(wide: DataFrame, salespersons: DataFrame) -> DataFrame:
    """Salespersons again, as store managers, through the key the store brought in."""
    attributes = ["sk", "id", "name", "role"]
    role = renamed_role(salespersons, {f"salesperson_{a}": f"store_manager_{a}" for a in attributes})
    return left_join(wide, role, "store_manager_sk")


def join_date_role(wide: DataFrame, dates: DataFrame, key: str, prefix: str) -> DataFrame:
    """Dates in a role: key ``key``, six attributes named ``<prefix>_date``, ``<prefix>_year``, ..."""
    names = {"date_sk": key, "full_date": f"{prefix}_date"} | {p: f"{prefix}_{p}" for p in DATE_PARTS}
    return left_join(wide, renamed_role(dates, names), key)


def denormalise(
    fact: DataFrame,
    *,
    customers: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    salespersons: DataFrame,
    campaigns: DataFrame,
    dates: DataFrame,
    contract: Contract = SALES,
    salted: Collection[str] = (),
    computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """All joins, surrogate keys dropped, columns in contract order.

    ``computed`` are columns that follow from others of the joined rows, keys
    included. They are made after the last join, so that rows are shuffled
    without them.

    Customers and products, the dimensions that may outgrow a broadcast, come
    first, while the rows that would be shuffled are still narrow. A dimension
    that is derived, and small only in fact, is measured, so the wide rows are
    never shuffled by a key with a few values.
    """
    customers, products, stores, salespersons, campaigns, dates = map(
        broadcast_if_small, (customers, products, stores, salespersons, campaigns, dates)
    )
    wide = join_dimensions(
        fact,
        {
            "customer_sk": customers,
            "product_sk": products,
            "store_sk": stores,
            "salesperson_sk": salespersons,
            "campaign_sk": campaigns,
        },
        salted,
    )
    wide = join_store_manager(wide, salespersons)
    wide = join_date_role(wide, dates, "start_date_sk", "campaign_start")
    wide = join_date_role(wide, dates, "end_date_sk", "campaign_end")
    return drop_suffix(wide.withColumns(dict(computed or {}))).select(*contract.names)
