"""Literal seed rows of the three source tables (S5), for the full-load test."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.expr import line_total
from tidemark.spec import CUSTOMERS, ORDER_ITEMS, ORDERS


def seed_tables(spark: SparkSession, today: _dt.date, now: _dt.datetime
                ) -> dict[str, DataFrame]:
    """The seed snapshot: 5 customers, 5 orders, 6 order items.

    Fixed values of the modelled source system (stated as given): names,
    e-mails, phones, cities, states; order dates relative to ``today``,
    statuses, totals and shipping methods; products, quantities and prices.
    Omitted columns take their declared defaults; ``line_total`` is the
    generated column.
    """
    customers = [
        (1, "Alice", "Johnson", "alice.johnson@example.com", "555-0101", "New York", "NY", "US"),
        (2, "Bob", "Smith", "bob.smith@example.com", "555-0102", "Los Angeles", "CA", "US"),
        (3, "Carol", "Williams", "carol.w@example.com", "555-0103", "Chicago", "IL", "US"),
        (4, "David", "Brown", "david.b@example.com", "555-0104", "Houston", "TX", "US"),
        (5, "Eve", "Davis", "eve.davis@example.com", "555-0105", "Phoenix", "AZ", "US"),
    ]
    orders = [
        (1, 1, today - _dt.timedelta(days=10), "DELIVERED", Decimal("125.50"), "STANDARD"),
        (2, 1, today - _dt.timedelta(days=3), "SHIPPED", Decimal("250.00"), "EXPRESS"),
        (3, 2, today - _dt.timedelta(days=5), "PROCESSING", Decimal("75.99"), "STANDARD"),
        (4, 3, today - _dt.timedelta(days=1), "PENDING", Decimal("340.00"), "OVERNIGHT"),
        (5, 4, today, "PENDING", Decimal("88.25"), "STANDARD"),
    ]
    items = [
        (1, 1, 101, "Wireless Mouse", 1, Decimal("45.00"), Decimal("0")),
        (2, 1, 102, "USB-C Hub", 1, Decimal("80.50"), Decimal("0")),
        (3, 2, 103, "Mechanical Keyboard", 1, Decimal("250.00"), Decimal("0")),
        (4, 3, 104, "Laptop Stand", 1, Decimal("75.99"), Decimal("0")),
        (5, 4, 105, 'Monitor 27"', 1, Decimal("340.00"), Decimal("0")),
        (6, 5, 106, "Webcam HD", 1, Decimal("88.25"), Decimal("0")),
    ]
    from tidemark.functions.casting import apply_defaults, conform

    c = spark.createDataFrame(customers, "customer_id bigint, first_name string, "
                              "last_name string, email string, phone string, city string, "
                              "state string, country string")
    o = spark.createDataFrame(orders, "order_id bigint, customer_id bigint, order_date date, "
                              "status string, total_amount decimal(12,2), "
                              "shipping_method string")
    i = spark.createDataFrame(items, "item_id bigint, order_id bigint, product_id bigint, "
                              "product_name string, quantity bigint, unit_price decimal(10,2), "
                              "discount_pct decimal(5,2)")
    i = i.withColumn("line_total", line_total("quantity", "unit_price", "discount_pct"))
    out = {}
    for name, df, spec in (("customers", c, CUSTOMERS), ("orders", o, ORDERS),
                           ("order_items", i, ORDER_ITEMS)):
        df = apply_defaults(df, spec, now, today)
        out[name] = conform(df, spec)
    return out
