"""Scalar functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import casts, masking, text


def apply(spark, build, values, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def strings(values):
    return [None if v is None else str(v) for v in values]


def test_money(spark):
    found = apply(spark, casts.to_money, ["1.005", "-1.005", " 5 ", "1e3", "FREE", "", None])
    assert strings(found) == ["1.01", "-1.01", "5.00", "1000.00", None, None, None]


def test_whole_numbers_round_half_away(spark):
    assert apply(spark, casts.to_whole, ["2.5", "-2.5", "3", "x", "1e30"]) == [3, -3, 3, None, None]


def test_timestamps(spark):
    found = apply(spark, casts.to_timestamp, ["2024-01-02 03:04:05", "2024-01-02 03:04:05.123456", "not-a-date", "", "20240102030405"])
    assert strings(found) == ["2024-01-02 03:04:05", "2024-01-02 03:04:05.123456", None, None, None]


def test_booleans(spark):
    assert apply(spark, casts.to_boolean, ["True", "on", "OFF", "x", "n", "1", None]) == [True, True, False, None, False, True, None]


def test_dates(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2025-01-15 10:20:30' AS t")
    row = df.select(casts.date_key(F.col("t")), casts.month_start(F.col("t")), casts.iso_text(F.col("t"))).first()
    assert (row[0], str(row[1]), row[2]) == (20250115, "2025-01-01", "2025-01-15 10:20:30")


def test_email_masks(spark):
    values = ["priya.sharma@example.com", "a@x", "ab@x", "noat", "@x", "a@b@c", None]
    assert apply(spark, masking.mask_email, values) == ["p***@example.com", "a***@x", "a***@x", "noat", "@x", "a***@b@c", None]
    assert apply(spark, masking.mask_email_keep_length, values) == [
        "p**********a@example.com", "*@x", "**@x", "noat", "@x", "*@b@c", None
    ]


def test_phone_masks(spark):
    values = ["12", "1234", "+91 98765 43210", "call me", "", None]
    assert apply(spark, masking.mask_phone, values) == ["12", "1234", "*" * 11 + "3210", "***l me", "", None]
    assert apply(spark, masking.mask_phone_by_digits, values) == ["**", "1234", "*" * 11 + "3210", "*" * 7, "", None]


@pytest.mark.parametrize("value,long,short", [
    (1e7, "₹1.0 Cr", "₹1Cr"), (123456789.0, "₹12.3 Cr", "₹12Cr"), (1e5, "₹1.0 L", "₹1L"),
    (99999.0, "₹99,999", "₹99,999"), (-5.0, "₹-5", "₹-5"), (None, None, None),
])
def test_money_labels(spark, value, long, short):
    assert apply(spark, text.inr_label, [value], "DOUBLE") == [long]
    assert apply(spark, lambda c: text.inr_label(c, 0, ""), [value], "DOUBLE") == [short]


def test_labels_and_keys(spark):
    df = spark.sql("SELECT 2024 AS y, 3 AS m, 42 AS n")
    row = df.select(
        text.month_label(F.col("y"), F.col("m")), text.business_key("C", 7, F.col("n")),
        text.bin_label(F.lit(0.5), F.lit(1.5)),
    ).first()
    assert tuple(row) == ("2024-03", "C0000042", "0–2")
