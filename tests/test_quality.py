import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.casting import apply_defaults, cast_row, lowercase_columns, stamp_updated
from tidemark.functions.expr import full_name, line_total
from tidemark.operators import quality
from tidemark.spec import CUSTOMERS, ORDER_ITEMS, ORDERS


def _cust(spark, rows):
    return spark.createDataFrame(rows, "op string, customer_id bigint, state string")


def test_quarantine_reasons(spark):
    df = _cust(spark, [("I", 1, "NY"), (None, 2, "NY"), ("X", 3, "NY"), ("I", None, "NY"),
                       ("U", 5, "x" * 51)])
    good, bad = quality.split_valid(df, CUSTOMERS)
    assert [r["customer_id"] for r in good.collect()] == [1]
    reasons = {r["customer_id"]: r["_reject_reason"] for r in bad.collect()}
    assert reasons == {2: "null_op", 3: "bad_op", None: "null_key", 5: "too_long:state"}


def test_strict_reference_and_truncate(spark):
    df = _cust(spark, [("X", 3, "NY"), ("U", 5, "x" * 51)])
    good, bad = quality.split_valid(df, CUSTOMERS, strict_reference=True, on_overflow="truncate")
    assert bad.count() == 0
    assert {r["customer_id"]: len(r["state"]) for r in good.collect()} == {3: 2, 5: 50}


def test_bad_cast(spark):
    df = spark.createDataFrame([("I", "x"), ("I", "7")], "op string, customer_id string")
    typed = cast_row(df, CUSTOMERS)
    good, bad = quality.split_valid(typed, CUSTOMERS)
    assert [r["customer_id"] for r in good.collect()] == [7]
    assert [r["_reject_reason"] for r in bad.collect()] == ["null_key,bad_cast:customer_id"]


def test_line_total_and_full_name(spark):
    df = spark.createDataFrame([(3, Decimal("19.99"), Decimal("12.5"), "A", None)],
                               "q bigint, p decimal(10,2), d decimal(5,2), f string, l string")
    r = df.select(line_total("q", "p", "d").alias("t"), full_name("f", "l").alias("n")).first()
    assert r["t"] == Decimal("52.47") and r["n"] is None


def test_defaults_vs_explicit_null(spark):
    now, today = dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)
    absent = spark.createDataFrame([(1,)], "customer_id bigint")
    explicit = spark.createDataFrame([(1, None)], "customer_id bigint, country string")
    assert apply_defaults(absent, CUSTOMERS, now, today).first()["country"] == "US"
    assert apply_defaults(explicit, CUSTOMERS, now, today).first()["country"] is None
    o = apply_defaults(spark.createDataFrame([(1,)], "order_id bigint"), ORDERS, now, today).first()
    assert (o["status"], o["currency"], o["order_date"], o["total_amount"]) == \
        ("PENDING", "USD", today, Decimal("0.00"))


def test_stamp_updated_and_lowercase(spark):
    now = dt.datetime(2024, 5, 5)
    df = spark.createDataFrame([("U", None), ("I", None)], "OP string, UPDATED_AT timestamp")
    df = lowercase_columns(df)
    out = {r["op"]: r["updated_at"] for r in stamp_updated(df, CUSTOMERS, now).collect()}
    assert out["U"] is not None and out["I"] is None


def test_checks(spark):
    items = spark.createDataFrame([(1, 10), (2, 11), (3, None), (3, 10)],
                                  "item_id bigint, order_id bigint")
    orders = spark.createDataFrame([(10, "PENDING"), (12, "LOST"), (13, None)],
                                   "order_id bigint, status string")
    assert [r["item_id"] for r in quality.orphans(items, orders, {"order_id": "order_id"})
            .collect()] == [2]
    assert [(r["item_id"], r["n"]) for r in quality.duplicate_keys(items, ["item_id"]).collect()] \
        == [(3, 2)]
    dv = {(r["value"], r["is_null"]): r["n"] for r in
          quality.domain_violations(orders, "status", ORDERS.domains["status"]).collect()}
    assert dv == {("LOST", False): 1, (None, True): 1}
    nn = {r["col"]: r["n_null"] for r in quality.not_null_report(items, ["item_id", "order_id"],
                                                                   "items").collect()}
    assert nn == {"item_id": 0, "order_id": 1}
    assert quality.not_null_violations(items, ["order_id"]).count() == 1


def test_total_and_recomputed_mismatch(spark):
    orders = spark.createDataFrame([(1, 125.5), (2, 10.0), (3, 0.0)], "o bigint, total double")
    lines = spark.createDataFrame([(1, Decimal("45.00")), (1, Decimal("80.50")),
                                   (2, Decimal("9.99"))], "o bigint, amt decimal(12,2)")
    bad = quality.total_mismatch(orders, lines, "o", "total", F.col("amt"))
    assert [r["o"] for r in bad.collect()] == [2]
    items = spark.createDataFrame([(3, Decimal("19.99"), Decimal("12.5"), Decimal("52.47")),
                                   (1, Decimal("10.00"), Decimal("0"), Decimal("9.00"))],
                                  "q bigint, p decimal(10,2), d decimal(5,2), lt decimal(12,2)")
    mism = quality.recomputed_mismatch(items, "lt", line_total("q", "p", "d"))
    assert [r["lt"] for r in mism.collect()] == [Decimal("9.00")]


def test_layer_counts(spark):
    a = spark.range(3)
    out = {r["layer"]: r["n"] for r in quality.layer_counts({"raw": a, "x": a.limit(1)}).collect()}
    assert out == {"raw": 3, "x": 1}
    assert ORDER_ITEMS.surrogate_key == "item_key"


def test_project_and_json_fields(spark):
    from tidemark.functions.casting import extract_json_fields, project_spec
    from tidemark.spec import Field, TableSpec

    df = spark.createDataFrame([("x", 1, "NY", 9)], "extra string, customer_id bigint, "
                               "state string, ignored int")
    assert project_spec(df, CUSTOMERS).columns == ["customer_id", "state"]
    spec = TableSpec(name="j", keys=("k",), fields=(Field("k", "int"), Field("s", "string")))
    js = spark.createDataFrame([('{"k": 5, "s": "a"}',), ('{"k": "bad"}',), (None,)], "p string")
    got = [(r["k"], r["s"]) for r in extract_json_fields(js, "p", spec).collect()]
    assert got == [(5, "a"), (None, None), (None, None)]
    assert CUSTOMERS.source_prefix == "public/customers"
