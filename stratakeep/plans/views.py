"""Tables and mart of a warehouse as temporary views, for use from SQL."""

from __future__ import annotations

from stratakeep.plans import marts
from stratakeep.plans.pipelines import EVENT_AT
from stratakeep.plans.warehouse import Warehouse

# Names of the tables the jobs write.
LOADED_TABLES = (
    "hub_customer",
    "hub_email",
    "hub_cart",
    "hub_product",
    "sat_customer_collection",
    "sat_email",
    "sat_cart_collection",
    "sat_product_collection",
    "sat_cart_product",
    "sat_customer_primary_email",
    "sat_cart_adds_and_drops",
    "link_customer_email",
    "link_customer_cart",
    "link_cart_product",
)
REPLACED_TABLES = ("pit_customer",)


def register_views(warehouse: Warehouse) -> list[str]:
    """Create a view per table present and per mart table they allow.

    Views read what is stored when they are registered; register again after a
    load.
    """
    frames = {name: warehouse.read(name) for name in LOADED_TABLES if warehouse.has(name)}
    for name in REPLACED_TABLES:
        if warehouse.has_replaced(name):
            frames[name] = warehouse.read_replaced(name)
    mart = {
        "dim_product": (marts.dim_product, ("hub_product", "sat_product_collection"), {"sequence": EVENT_AT}),
        "dim_customer_history": (
            marts.dim_customer_history,
            ("pit_customer", "hub_customer", "sat_customer_primary_email", "sat_customer_collection"),
            {"sequence": EVENT_AT},
        ),
        "fact_cart_adds_and_drops": (
            marts.fact_cart_adds_and_drops,
            ("sat_cart_adds_and_drops", "link_cart_product", "link_customer_cart"),
            {},
        ),
    }
    for name, (build, needed, options) in mart.items():
        if all(table in frames for table in needed):
            frames[name] = build(*[frames[table] for table in needed], **options)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
