"""The raw tables every rule and builder reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.operators.dedup import key_losers
from tidyledger.schemas import RAW_COLUMNS, SOURCE_ROW


class Staging:
    """All-text raw tables with ``source_row``, given as DataFrames or as functions that make them."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
        orders_distinct: DataFrame | None = None,
    ):
        self._tables = dict(tables)
        self._orders_distinct = orders_distinct

    def _table(self, name: str) -> DataFrame:
        table = self._tables[name]
        return table if isinstance(table, DataFrame) else table()

    @cached_property
    def customers(self) -> DataFrame:
        return self._table("customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._table("products")

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("orders")

    @cached_property
    def payments(self) -> DataFrame:
        return self._table("payments")

    @cached_property
    def support_tickets(self) -> DataFrame:
        return self._table("support_tickets")

    @cached_property
    def order_contents(self) -> DataFrame:
        """Distinct order contents with the first position and the number of copies.

        One grouping for all who need either: the filter keeps both aggregates in every plan, so plans that contain it
        more than once shuffle the orders once.
        """
        both = [F.min(SOURCE_ROW).alias(SOURCE_ROW), F.count(F.lit(1)).alias("copies")]
        contents = self.orders.groupBy(*RAW_COLUMNS["orders"]).agg(*both)
        return contents.filter(F.col(SOURCE_ROW).isNotNull() & (F.col("copies") > 0))

    @cached_property
    def kept_orders(self) -> DataFrame:
        """Orders without identical repeats: the table a batch run wrote, or else derived here."""
        return self.order_contents.drop("copies") if self._orders_distinct is None else self._orders_distinct

    def with_orders_distinct(self, df: DataFrame) -> Staging:
        return Staging(self._tables, df)

    @cached_property
    def customers_duplicates(self) -> DataFrame:
        """Customer rows after the first of their id."""
        return key_losers(self.customers, ["customer_id"])

    @cached_property
    def orders_duplicates(self) -> DataFrame:
        """Identical repeats and id collisions together: every order row after the first of its id."""
        return key_losers(self.orders, ["order_id"])
