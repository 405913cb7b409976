"""Quarantine rules and deduplication against a plain Python model."""

import json
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import dedupe
from tillhouse.operators.rules import CONTENT_FIRST, ENTITY, ORDER_ITEMS, ORDERS, PRODUCTS, REFERENCE
from tillhouse.operators.staging import quality_counts, reason_counts, rejected_fields, stage
from tillhouse.schema import SCHEMAS, raw_schema
from tillhouse.sources.testdata import RawTables

# Reasons per entity and mode on the benchmark tables of scale 0.01.
EXPECTED = {
    ("customers", REFERENCE): {
        "clean": 1260, "duplicate_customer_code": 30, "missing_city": 60, "missing_email": 30,
        "missing_name": 30, "phone_type_mismatch": 30, "invalid_date_format": 30, "future_updated_at": 30,
    },
    ("products", REFERENCE): {
        "clean": 1741, "duplicate_product_code": 34, "missing_category": 75, "missing_name": 50,
        "negative_price": 50, "price_type_mismatch": 50,
    },
    ("products", CONTENT_FIRST): {
        "clean": 1750, "duplicate_product_code": 25, "missing_category": 75, "missing_name": 50,
        "negative_price": 50, "price_type_mismatch": 50,
    },
    ("orders", CONTENT_FIRST): {
        "clean": 13323, "duplicate_order_id": 370, "future_order_date": 182, "orphan_customer": 375,
        "missing_order_state": 375, "invalid_date_format": 375,
    },
    ("order_items", CONTENT_FIRST): {
        "clean": 34028, "duplicate_order_item_id": 6986, "orphan_order": 2451, "orphan_product": 2382,
        "missing_quantity": 2293, "negative_quantity": 2392, "price_type_mismatch": 2402,
        "negative_unit_price": 2374, "missing_line_amount": 2371, "negative_line_amount": 2321,
    },
    ("payments", CONTENT_FIRST): {
        "clean": 11849, "duplicate_payment_id": 488, "future_payment_date": 163, "orphan_order": 500,
        "missing_payment_method": 500, "amount_type_mismatch": 500, "negative_payment_amount": 500,
        "invalid_date_format": 500,
    },
}


@pytest.mark.parametrize("entity,mode", EXPECTED)
def test_known_counts(spark, as_of, entity, mode):
    raw = RawTables(spark, "/root/testdata/sf0.01")[entity]
    counts = quality_counts(raw, ENTITY[entity], as_of, mode)
    assert {r.reason: r.n for r in counts.collect()} == EXPECTED[entity, mode]


def frame(spark, entity, rows):
    return spark.createDataFrame(rows, raw_schema(entity))


def reasons(spark, as_of, entity, row, strict=False):
    staged = stage(frame(spark, entity, [row]), ENTITY[entity], as_of, strict=strict)
    return [r.reason for r in staged.errors.collect()]


GOOD = {
    "customers": ("C1", "a", "b", "a b", "a@x.org", "male", "Pune", "MH", "+91 1", "1995-01-01 00:00:00", "1996-01-01 00:00:00", "True"),
    "products": ("P1", "pen", "Toys", "1.50", "True"),
    "orders": ("O1", "C1", "1999-01-01 10:20:30.123456", "PLACED", "Pune", "MH"),
    "order_items": ("OI1", "O1", "P1", "2", "1.50", "3.00"),
    "payments": ("PM1", "O1", "3.00", "UPI", "1999-01-01 10:20:30"),
}


def spoil(entity, **cells):
    names = ENTITY[entity].columns
    return tuple(cells.get(name, value) for name, value in zip(names, GOOD[entity]))


@pytest.mark.parametrize("entity", GOOD)
def test_good_row_is_clean(spark, as_of, entity):
    staged = stage(frame(spark, entity, [GOOD[entity]]), ENTITY[entity], as_of)
    assert staged.clean.count() == 1 and staged.errors.count() == 0
    declared = spark.createDataFrame([], SCHEMAS["staging"][f"{entity}_clean"]).dtypes
    assert staged.clean.dtypes == declared


@pytest.mark.parametrize(
    "entity,cells,reason",
    [
        ("customers", {"customer_code": None, "city": None}, "missing_customer_code"),
        ("customers", {"city": "  ", "email": None}, "missing_city"),
        ("customers", {"email": ""}, "missing_email"),
        ("customers", {"phone": "NOT_A_NUMBER"}, "phone_type_mismatch"),
        ("customers", {"full_name": " "}, "missing_name"),
        ("customers", {"updated_at": "soon"}, "invalid_date_format"),
        ("customers", {"updated_at": None}, "invalid_date_format"),
        ("customers", {"updated_at": "2001-07-01 00:00:00.000001"}, "future_updated_at"),
        ("products", {"product_code": None}, "missing_product_code"),
        ("products", {"unit_price": None}, "price_type_mismatch"),
        ("products", {"unit_price": "-0.01"}, "negative_price"),
        ("orders", {"order_id": None}, "missing_order_id"),
        ("orders", {"customer_code": "__ORPHAN__", "order_state": None}, "orphan_customer"),
        ("order_items", {"order_item_id": None}, "missing_order_item_id"),
        ("order_items", {"order_id": "__ORPHAN__", "product_code": "__ORPHAN__"}, "orphan_order"),
        ("order_items", {"quantity": "-0.001"}, "negative_quantity"),
        ("order_items", {"line_amount": "-0.001"}, "negative_line_amount"),
        ("payments", {"payment_id": None}, "missing_payment_id"),
        ("payments", {"payment_method": " "}, "missing_payment_method"),
    ],
)
def test_rule(spark, as_of, entity, cells, reason):
    assert reasons(spark, as_of, entity, spoil(entity, **cells)) == [reason]


@pytest.mark.parametrize(
    "entity,cells",
    [
        ("customers", {"phone": None}),
        ("customers", {"updated_at": "2001-07-01 00:00:00"}),  # exactly now is not the future
        ("orders", {"customer_code": None}),  # only the sentinel is rejected
        ("order_items", {"quantity": "two"}),
    ],
)
def test_not_a_defect(spark, as_of, entity, cells):
    assert reasons(spark, as_of, entity, spoil(entity, **cells)) == []


def test_strict_adds_number_checks(spark, as_of):
    assert reasons(spark, as_of, "order_items", spoil("order_items", quantity="two"), strict=True) == [
        "quantity_type_mismatch"
    ]
    assert reasons(spark, as_of, "order_items", spoil("order_items", line_amount="x"), strict=True) == [
        "amount_type_mismatch"
    ]


def test_typing(spark, as_of):
    rows = [spoil("products", product_code=f"P{i}", unit_price=p, is_active=a) for i, (p, a) in enumerate(
        [("1.005", "on"), (" 5 ", "off"), ("1e3", "x"), ("7", "YES")]
    )]
    clean = stage(frame(spark, "products", rows), PRODUCTS, as_of).clean.orderBy("product_code").collect()
    assert [(r.unit_price, r.is_active) for r in clean] == [
        (Decimal("1.01"), True), (Decimal("5.00"), False), (Decimal("1000.00"), None), (Decimal("7.00"), True),
    ]


def test_unfit_row_takes_the_key_in_reference_mode(spark, as_of):
    rows = [spoil("products", product_name="a", unit_price="FREE"), spoil("products", product_name="b")]
    raw = frame(spark, "products", rows)
    assert stage(raw, PRODUCTS, as_of, REFERENCE).clean.count() == 0
    assert stage(raw, PRODUCTS, as_of, CONTENT_FIRST).clean.count() == 1
    found = {r.reason for r in stage(raw, PRODUCTS, as_of, REFERENCE).errors.collect()}
    assert found == {"price_type_mismatch", "duplicate_product_code"}


def test_mode_must_fit(spark, as_of):
    with pytest.raises(ValueError):
        stage(frame(spark, "orders", []), ORDERS, as_of, REFERENCE)


def test_empty(spark, as_of):
    staged = stage(frame(spark, "orders", []), ORDERS, as_of)
    assert staged.clean.count() == 0 and staged.errors.count() == 0
    assert quality_counts(frame(spark, "orders", []), ORDERS, as_of).count() == 0


def model(entity, rows, mode):
    """Which row of a key is first, in plain Python: (clean rows, error rows by reason)."""

    def why(row):
        cells = dict(zip(entity.columns, row))
        if cells["product_code"] is None:
            return "missing_product_code"
        if not (cells["product_name"] or "").strip():
            return "missing_name"
        if not (cells["category"] or "").strip():
            return "missing_category"
        if cells["unit_price"] == "FREE":
            return "price_type_mismatch"
        return "negative_price" if cells["unit_price"].startswith("-") else None

    def place(row):
        cells = dict(zip(entity.columns, row))
        head = [(cells[c] is None, cells[c] or "") for c in entity.ranked_columns()]
        rest = [(cells[c] is not None, cells[c] or "") for c in entity.total_order()[len(head):]]
        return ([] if mode == REFERENCE else [why(row) is not None]) + head + rest

    keys = defaultdict(list)
    for row in rows:
        keys[row[0]].append(row)
    clean, errors = [], Counter()
    for key, group in keys.items():
        for i, row in enumerate(sorted(group, key=place)):
            if why(row):
                errors[why(row), row] += 1
            elif i == 0:
                clean.append(row)
            else:
                errors[entity.duplicate_reason, row] += 1
    return Counter(clean), errors


@pytest.mark.parametrize("mode", [REFERENCE, CONTENT_FIRST])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_model(spark, as_of, mode, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, "P1", "P1", "P1", "P2", "P3", f"P{rng.randrange(40)}"]),
            rng.choice([None, " ", "a", "b", "c"]),
            rng.choice(["x", "y", None]),
            rng.choice(["1.00", "2.00", "FREE", "-1.00"]),
            rng.choice(["True", "False", None]),
        )
        for _ in range(1500)
    ]
    raw = frame(spark, "products", rows).repartition(6)
    staged = stage(raw, PRODUCTS, as_of, mode)
    clean, errors = model(PRODUCTS, rows, mode)
    truth = {"True": True, "False": False, None: None}
    assert Counter(
        (r.product_code, r.product_name, r.category, str(r.unit_price), r.is_active) for r in staged.clean.collect()
    ) == Counter({(a, b, c, d, truth[e]): n for (a, b, c, d, e), n in clean.items()})
    found = Counter()
    for r in staged.errors.collect():
        cells = json.loads(r.row_data)
        found[r.reason, tuple(cells.get(c) for c in PRODUCTS.columns)] += 1
    assert found == errors
    counts = {r.reason: r.n for r in quality_counts(raw, PRODUCTS, as_of, mode).collect()}
    expected = Counter({"clean": sum(clean.values())})
    for (reason, _), n in errors.items():
        expected[reason] += n
    assert counts == {k: v for k, v in expected.items() if v}


def test_many_exact_copies(spark, as_of, monkeypatch):
    """A third of all rows are one row; the copies are written out in several chunks."""
    monkeypatch.setattr(dedupe, "_CHUNK", 70)
    unique = spark.range(2000).select(
        F.format_string("OI%d", "id").alias("order_item_id"), F.lit("O1").alias("order_id"),
        F.lit("P1").alias("product_code"), F.lit("1").alias("quantity"),
        F.lit("2.00").alias("unit_price"), F.lit("2.00").alias("line_amount"),
    )
    copies = spark.range(1000).select(F.lit("OI5").alias("order_item_id"), *[
        F.lit(v).alias(c) for c, v in zip(ORDER_ITEMS.columns[1:], ("O1", "P1", "1", "2.00", "2.00"))
    ])
    staged = stage(unique.unionByName(copies), ORDER_ITEMS, as_of)
    assert staged.clean.count() == 2000
    assert [(r.reason, r.cnt) for r in reason_counts(staged.errors).collect()] == [
        ("duplicate_order_item_id", 1000)
    ]
    assert staged.errors.select("row_data").distinct().count() == 1


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_few_repeated_keys_shuffle_no_fit_row(spark, as_of, settings):
    """The repeated keys are known before the plan is made: they are broadcast, and only their rows move."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    raw = spark.range(0, 20_000, 1, 4).select(
        F.format_string("O%d", F.when(F.col("id") < 5, 7).otherwise(F.col("id"))).alias("order_id"), F.lit("C1").alias("customer_code"),
        F.lit("1999-01-01 00:00:00").alias("order_date"), *[F.lit("x").alias(c) for c in ("status", "order_city", "order_state")],
    )
    staged = stage(raw, ORDERS, as_of)
    plan = final_plan(staged.clean)
    once = plan.split("Union")[1].split("HashAggregate")[0].split("SortAggregate")[0]
    assert "BroadcastHashJoin" in once and "SortMergeJoin" not in plan
    # The only rows that are exchanged are those of the repeated keys.
    assert plan.count("Exchange hashpartitioning") == 1
    assert staged.clean.count() == 19_995


def test_landed_rows_are_read_instead_of_raw(spark, as_of):
    raw = RawTables(spark, "/root/testdata/sf0.001")["order_items"]
    staged, plain = stage(raw, ORDER_ITEMS, as_of), stage(raw, ORDER_ITEMS, as_of)
    counts = staged.land()
    assert sum(counts.values()) == raw.count()
    for kind in ("clean", "errors"):
        assert not any("lineitem" in f for f in getattr(staged, kind).inputFiles())
        assert any("lineitem" in f for f in getattr(plain, kind).inputFiles())
        assert sorted(map(str, getattr(staged, kind).collect())) == sorted(map(str, getattr(plain, kind).collect()))
    found = {r.reason: r.n for r in quality_counts(raw, ORDER_ITEMS, as_of).collect()}
    assert {k: v for k, v in counts.items() if k != "fit"} == {k: v for k, v in found.items() if k not in ("clean", "duplicate_order_item_id")}
    staged.discard()


def test_rejected_fields_come_back_typed(spark, as_of):
    rows = [spoil("order_items", quantity="-2"), spoil("order_items", order_item_id="X", unit_price="TWENTY", quantity=None)]
    errors = stage(frame(spark, "order_items", rows), ORDER_ITEMS, as_of).errors
    found = rejected_fields(errors, {"order_item_id": "string", "quantity": "bigint", "unit_price": "decimal(18,2)", "other": "int"})
    assert {tuple(r) for r in found.collect()} == {
        ("negative_quantity", "OI1", -2, Decimal("1.50"), None), ("missing_quantity", "X", None, None, None),
    }
