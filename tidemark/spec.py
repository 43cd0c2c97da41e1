"""Table specifications: one spec drives ingest, de-duplication and merge.

A ``TableSpec`` describes a keyed source table, the change files that carry
its events, and the curated (soft-delete, latest-state-wins) table that the
events are merged into.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import types as T

_SIMPLE_TYPES = {
    "bigint": T.LongType(), "long": T.LongType(), "int": T.IntegerType(),
    "integer": T.IntegerType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(), "double": T.DoubleType(),
}


def spark_type(text: str) -> T.DataType:
    """Spark type from the small type vocabulary used by specs."""
    text = text.strip().lower()
    m = re.fullmatch(r"decimal\((\d+)\s*,\s*(\d+)\)", text)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    return _SIMPLE_TYPES[text]


# Op codes of a change event.
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"
OPS = (OP_INSERT, OP_UPDATE, OP_DELETE)


@dataclass(frozen=True)
class Field:
    """A column of a source table as it appears in a change file.

    ``dtype`` is a Spark SQL type string; ``max_len`` is the VARCHAR length
    rule (Spark strings have none); ``default`` is a SQL literal text, or the
    markers ``now`` / ``today`` resolved by :func:`apply_defaults`.
    """

    name: str
    dtype: str
    max_len: int | None = None
    nullable: bool = True
    default: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]
    # curated table
    curated_name: str = ""
    renames: Mapping[str, str] = field(default_factory=dict)  # source -> curated
    update_columns: tuple[str, ...] = ()  # curated names set on U/I
    insert_only: tuple[str, ...] = ()  # curated names set only on insert
    computed: Mapping[str, str] = field(default_factory=dict)  # curated name -> SQL
    surrogate_key: str | None = None
    has_first_seen: bool = False
    # change-event columns
    op_col: str = "op"
    ts_col: str = "_captured_at"
    # extra descending order keys after ts and op priority (W2 tie-break)
    tiebreak: tuple[str, ...] = ("_source_file", "_source_file_row")
    # checks
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()  # NOT NULL in the curated table, beside the key
    # where change files land, relative to the landing root
    source_prefix: str = ""
    stamp_updated: str | None = None  # column stamped on update (P9)

    # -- derived ---------------------------------------------------------
    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def curated(self, source_name: str) -> str:
        return self.renames.get(source_name, source_name)

    @property
    def schema(self) -> T.StructType:
        """Schema of the typed source row (no op / ts columns)."""
        return T.StructType([
            T.StructField(f.name, spark_type(f.dtype), True)
            for f in self.fields
        ])

    @property
    def change_schema(self) -> T.StructType:
        """Schema of a change file: op + capture time + the source row."""
        return T.StructType(
            [T.StructField(self.op_col, T.StringType(), True),
             T.StructField(self.ts_col, T.TimestampNTZType(), True)]
            + list(self.schema.fields))

    @property
    def event_columns(self) -> list[str]:
        """Curated-named columns carried by a de-duplicated event."""
        cols = list(self.keys)
        for c in self.update_columns + self.insert_only:
            if c not in cols:
                cols.append(c)
        return cols

    @property
    def curated_columns(self) -> list[str]:
        cols: list[str] = []
        if self.surrogate_key:
            cols.append(self.surrogate_key)
        cols += self.event_columns
        cols += list(self.computed)
        if self.has_first_seen:
            cols.append("dw_first_seen_at")
        cols += ["dw_last_updated_at", "is_deleted"]
        return cols


# ---------------------------------------------------------------------------
# Fixed values of the modelled source system (must stay as stated):
#   customer_status domain: ACTIVE, INACTIVE, SUSPENDED
#   order status domain:    PENDING, PROCESSING, SHIPPED, DELIVERED, CANCELLED
#   op domain:              I, U, D
#   defaults: country 'US', customer_status 'ACTIVE', order status 'PENDING',
#             total_amount 0, currency 'USD', quantity 1, discount_pct 0,
#             created_at / updated_at now, order_date today
#   VARCHAR lengths as declared below
# ---------------------------------------------------------------------------
CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE", "SUSPENDED")
ORDER_STATUSES = ("PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED")

CUSTOMERS = TableSpec(
    name="customers",
    curated_name="dim_customers",
    keys=("customer_id",),
    fields=(
        Field("customer_id", "bigint", nullable=False),
        Field("first_name", "string", 100, nullable=False),
        Field("last_name", "string", 100, nullable=False),
        Field("email", "string", 255, nullable=False),
        Field("phone", "string", 20),
        Field("address_line1", "string", 255),
        Field("address_line2", "string", 255),
        Field("city", "string", 100),
        Field("state", "string", 50),
        Field("postal_code", "string", 20),
        Field("country", "string", 50, default="'US'"),
        Field("customer_status", "string", 20, default="'ACTIVE'"),
        Field("created_at", "timestamp", default="now"),
        Field("updated_at", "timestamp", default="now"),
    ),
    renames={"created_at": "src_created_at", "updated_at": "src_updated_at"},
    update_columns=("first_name", "last_name", "email", "phone", "address_line1",
                    "address_line2", "city", "state", "postal_code", "country",
                    "customer_status", "src_updated_at"),
    insert_only=("src_created_at",),
    computed={"full_name": "first_name || ' ' || last_name"},
    surrogate_key="customer_key",
    has_first_seen=True,
    domains={"customer_status": CUSTOMER_STATUSES},
    unique=(("customer_id",), ("email",)),
    source_prefix="public/customers",
    stamp_updated="updated_at",
)

ORDERS = TableSpec(
    name="orders",
    curated_name="fact_orders",
    keys=("order_id",),
    fields=(
        Field("order_id", "bigint", nullable=False),
        Field("customer_id", "bigint", nullable=False),
        Field("order_date", "date", nullable=False, default="today"),
        Field("ship_date", "date"),
        Field("status", "string", 30, default="'PENDING'"),
        Field("total_amount", "decimal(12,2)", nullable=False, default="0"),
        Field("currency", "string", 3, default="'USD'"),
        Field("shipping_method", "string", 50),
        Field("notes", "string"),
        Field("created_at", "timestamp", default="now"),
        Field("updated_at", "timestamp", default="now"),
    ),
    renames={"status": "order_status", "created_at": "src_created_at",
             "updated_at": "src_updated_at"},
    update_columns=("customer_id", "order_date", "ship_date", "order_status",
                    "total_amount", "currency", "shipping_method", "notes",
                    "src_updated_at"),
    insert_only=("src_created_at",),
    surrogate_key="order_key",
    domains={"status": ORDER_STATUSES},
    foreign_keys={"customer_id": ("customers", "customer_id")},
    required=("customer_id",),
    unique=(("order_id",),),
    source_prefix="public/orders",
    stamp_updated="updated_at",
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    curated_name="fact_order_items",
    keys=("item_id",),
    fields=(
        Field("item_id", "bigint", nullable=False),
        Field("order_id", "bigint", nullable=False),
        Field("product_id", "bigint", nullable=False),
        Field("product_name", "string", 255, nullable=False),
        Field("quantity", "bigint", nullable=False, default="1"),
        Field("unit_price", "decimal(10,2)", nullable=False),
        Field("discount_pct", "decimal(5,2)", default="0"),
        Field("line_total", "decimal(12,2)"),
        Field("created_at", "timestamp", default="now"),
    ),
    renames={"created_at": "src_created_at"},
    update_columns=("order_id", "product_id", "product_name", "quantity",
                    "unit_price", "discount_pct", "line_total"),
    insert_only=("src_created_at",),
    surrogate_key="item_key",
    foreign_keys={"order_id": ("orders", "order_id")},
    required=("order_id",),
    unique=(("item_id",),),
    source_prefix="public/order_items",
)

SPECS = {s.name: s for s in (CUSTOMERS, ORDERS, ORDER_ITEMS)}
