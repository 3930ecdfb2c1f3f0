"""The tables that are moved: names, keys and typed columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: str
    ddl: str
    #: Columns whose text is the same in every engine, which the checksum is made of.
    checksum: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        """Names alone need no session."""
        return [c.split()[0] for c in re.split(r",\s*(?![^(]*\))", self.ddl)]

    @property
    def business_columns(self) -> list[str]:
        return self.columns

    def topic(self, prefix: str = "cdc.public") -> str:
        return f"{prefix}.{self.name}"

    def value_subject(self, prefix: str = "cdc.public") -> str:
        return f"{self.topic(prefix)}-value"


def _spec(name: str, key: str, ddl: str, checksum: str) -> TableSpec:
    return TableSpec(name, key, ddl, tuple(checksum.split()))


TABLES: dict[str, TableSpec] = {
    s.name: s
    for s in (
        _spec(
            "customers",
            "customer_id",
            "customer_id bigint, name string, email string, segment string, region string, created_at timestamp_ntz, updated_at timestamp_ntz",
            "customer_id name email segment region",
        ),
        _spec(
            "products",
            "product_id",
            "product_id bigint, name string, category string, unit_cost decimal(12,2), is_active boolean, created_at timestamp_ntz",
            "product_id name category",
        ),
        _spec(
            "orders",
            "order_id",
            "order_id bigint, customer_id bigint, product_id bigint, quantity int, unit_price decimal(12,2), status string, channel string, created_at timestamp_ntz, updated_at timestamp_ntz",
            "order_id customer_id product_id quantity status channel",
        ),
        _spec(
            "inventory",
            "inventory_id",
            "inventory_id bigint, product_id bigint, warehouse_id int, quantity int, reorder_point int, updated_at timestamp_ntz",
            "inventory_id product_id warehouse_id quantity reorder_point",
        ),
        _spec(
            "shipments",
            "shipment_id",
            "shipment_id bigint, order_id bigint, carrier string, status string, shipped_at timestamp_ntz, delivered_at timestamp_ntz, estimated_delivery timestamp_ntz",
            "shipment_id order_id carrier status",
        ),
    )
}

#: Gold and staging models that read each table.
DOWNSTREAM: dict[str, tuple[str, ...]] = {
    "orders": ("stg_orders", "gold_revenue_daily", "gold_customer_segments", "gold_migration_summary"),
    "customers": ("stg_customers", "gold_customer_segments"),
    "products": ("stg_products", "gold_inventory_health"),
    "inventory": ("stg_inventory", "gold_inventory_health"),
    "shipments": ("gold_migration_summary",),
}
