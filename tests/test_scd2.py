"""Customer history."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.casts import moment
from tillhouse.plans import analytics, dims, fact, scd2
from tillhouse.schema import SCHEMAS

CLEAN = SCHEMAS["staging"]["customers_clean"]
T0, T1, T2 = datetime(1995, 1, 1), datetime(2001, 7, 1), datetime(2002, 1, 1)


def customer(code, email="ann@x.org", city="Pune", phone="+91 12345", name="Ann", state="MH"):
    return (code, "a", "b", name, email, "f", city, state, phone, T0, T0, True)


def load(spark, *rows):
    return spark.createDataFrame(list(rows), CLEAN)


def versions(df, code):
    rows = df.filter(F.col("customer_code") == code).orderBy("eff_start_date", "customer_sk").collect()
    return [(r.city, r.eff_start_date, r.eff_end_date, r.is_current) for r in rows]


@pytest.mark.parametrize(
    "change,reference,null_safe",
    [
        ({"city": "Porto"}, 2, 2),
        ({"email": "zoe@x.org"}, 2, 2),
        ({"email": "amy@x.org"}, 1, 1),  # same mask
        ({"phone": None}, 1, 2),
        ({"phone": "+91 92345"}, 1, 1),  # same length and last four
        ({"state": "KA"}, 1, 1),  # not tracked
        ({"name": "Bea"}, 1, 1),
        ({}, 1, 1),
    ],
)
def test_what_opens_a_version(spark, change, reference, null_safe):
    dim = dims.build_dim_customer(load(spark, customer("C1"), customer("C2")))
    source = load(spark, customer("C1", **change), customer("C2"))
    for mode, n in (("reference", reference), ("null_safe", null_safe)):
        after = scd2.scd2_apply(dim, source, moment(T1), mode)
        assert len(versions(after, "C1")) == n
        assert len(versions(after, "C2")) == 1


def test_expire_insert_and_keep(spark):
    dim = dims.build_dim_customer(load(spark, customer("C1"), customer("GONE")))
    source = load(spark, customer("C1", city="Delhi"), customer("NEW"))
    after = scd2.scd2_apply(dim, source, moment(T1))
    assert versions(after, "C1") == [("Pune", T0, T1, False), ("Delhi", T1, None, True)]
    assert versions(after, "NEW") == [("Pune", T1, None, True)]
    assert versions(after, "GONE") == [("Pune", T0, None, True)]
    assert sorted(r.customer_sk for r in after.collect()) == [1, 2, 3, 4]
    assert after.dtypes == spark.createDataFrame([], SCHEMAS["dw"]["dim_customer"]).dtypes


def test_again_and_again(spark):
    source = load(spark, customer("C1", city="Delhi"))
    once = scd2.scd2_apply(dims.build_dim_customer(load(spark, customer("C1"))), source, moment(T1))
    twice = scd2.scd2_apply(once, source, moment(T2))
    assert sorted(twice.collect()) == sorted(once.collect())
    back = scd2.scd2_apply(once, load(spark, customer("C1")), moment(T2))
    assert [v[0] for v in versions(back, "C1")] == ["Pune", "Delhi", "Pune"]
    assert [v[3] for v in versions(back, "C1")] == [False, False, True]
    assert [r.city for r in scd2.history(back, "C1").collect()] == ["Pune", "Delhi", "Pune"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        scd2.changed("other")


def test_old_sales_lose_a_moved_customer_only_in_current_view(spark):
    dim = dims.build_dim_customer(load(spark, customer("C1"), customer("C2")))
    sk = {r.customer_code: r.customer_sk for r in dim.collect()}
    sales = spark.createDataFrame(
        [("I1", "O1", sk["C1"], 1, 1, 20010101, 1, None, None, "X"), ("I2", "O2", sk["C2"], 1, 1, 20010101, 1, None, None, "X")],
        SCHEMAS["dw"]["fact_sales"],
    ).withColumn("line_amount", F.lit("10.00").cast("decimal(18,2)"))
    after = scd2.scd2_apply(dim, load(spark, customer("C1", city="Delhi"), customer("C2")), moment(T1))
    book = dims.Dims(
        dims.build_dim_date(spark, "2001-01-01", 3),
        spark.createDataFrame([], SCHEMAS["dw"]["dim_product"]),
        spark.createDataFrame([], SCHEMAS["dw"]["dim_location"]),
        after,
    )
    now = fact.star(sales, book).orderBy("order_item_id").collect()
    assert [r.customer_code for r in now] == [None, "C2"]
    then = fact.star(sales, book, current_only=False).orderBy("order_item_id").collect()
    assert [(r.customer_code, r.customer_city) for r in then] == [("C1", "Pune"), ("C2", "Pune")]
    row = analytics.kpis(sales, book).first()
    assert (row.total_revenue, row.total_orders, row.unique_customers) == (20.0, 2, 1)
    assert analytics.kpis(sales, book, current_only=False).first().unique_customers == 2
