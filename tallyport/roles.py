"""Which physical table plays which commerce role.

Operators read a `Commerce` object, never a path. `from_catalog` maps the nine
tables of the commerce schema one to one; `from_star` derives the same nine roles
from a star schema (orders, lineitem, part, customer, supplier, ...). Everything
stays lazy, so an operator that touches two roles scans two tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.schemas import BASE_TABLES
from tallyport.session import Tables


ROLES = (
    "orders", "order_items", "products", "customers", "sellers", "payments", "order_reviews", "geolocation",
    "translation", "text_reviews",
)


class Commerce:
    """The role frames, each made on first use so that a query opens only its own tables.

    `text_reviews` are the reviews that carry text: the same table as
    `order_reviews` unless the source keeps them apart.
    """

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]], delivered_status: str = "delivered"):
        self._makers = dict(makers)
        self.delivered_status = delivered_status

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_") or role not in self._makers:
            raise AttributeError(role)
        frame = self._makers[role]()
        setattr(self, role, frame)
        return frame

    def delivered_orders(self) -> DataFrame:
        return self.orders.filter(F.col("order_status") == self.delivered_status)


def from_tables(table: Callable[[str], DataFrame], delivered_status: str = "delivered") -> Commerce:
    """Roles over the nine commerce tables, opened by name."""
    names = {role: role for role in ROLES} | {
        "translation": "product_category_name_translation", "text_reviews": "order_reviews",
    }
    return Commerce({role: partial(table, name) for role, name in names.items()}, delivered_status)


def from_frames(tables: Mapping[str, DataFrame], delivered_status: str = "delivered") -> Commerce:
    return from_tables(tables.__getitem__, delivered_status)


def from_catalog(spark: SparkSession, database: str | None = None) -> Commerce:
    tables = Tables(spark)
    prefix = f"{database}." if database else ""
    return from_tables(lambda name: tables.table(prefix + name))


def from_parquet(spark: SparkSession, root: str) -> Commerce:
    tables = Tables(spark)
    return from_tables(lambda name: tables.parquet(f"{root}/{name}", BASE_TABLES[name]))
