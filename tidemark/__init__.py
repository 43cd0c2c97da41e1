"""tidemark: change-data capture on Spark.

Change files land in an append-only RAW layer, the latest event per key is
kept with a total order, and inserts, updates and soft deletes are merged
into keyed curated tables -- per micro-batch or as one closed-form replay of
the whole log.  Everything is DataFrame / Spark SQL; no row-level Python.
"""

from tidemark.spec import Field, TableSpec, CUSTOMERS, ORDERS, ORDER_ITEMS, SPECS

__all__ = ["Field", "TableSpec", "CUSTOMERS", "ORDERS", "ORDER_ITEMS", "SPECS"]
