"""Surrogate keys and row changes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillhouse.operators.keys import assign_sk, key_bucket, next_sk
from tillhouse.operators.mutate import delete_where, update_where


def codes(spark, n, partitions):
    return spark.range(n).select(F.format_string("C%05d", "id").alias("code")).repartition(partitions)


def test_same_as_one_global_numbering(spark):
    df = codes(spark, 3000, 7)
    order = Window.orderBy(key_bucket(["code"]), "code")
    naive = {r.code: r.sk for r in df.withColumn("sk", F.row_number().over(order)).collect()}
    assert {r.code: r.sk for r in assign_sk(df, ["code"], "sk").collect()} == naive
    assert sorted(naive.values()) == list(range(1, 3001))


def test_numbers_do_not_depend_on_partitions(spark):
    few = assign_sk(codes(spark, 500, 2), ["code"], "sk", start=100).collect()
    many = assign_sk(codes(spark, 500, 9), ["code"], "sk", start=100).collect()
    assert sorted(few) == sorted(many)
    assert min(r.sk for r in few) == 100


def test_two_part_key_with_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "c STRING, s STRING")
    assert sorted(r.sk for r in assign_sk(df, ["c", "s"], "sk").collect()) == [1, 2, 3]


def test_next_key(spark):
    df = spark.createDataFrame([(4,), (9,)], "sk BIGINT")
    one = spark.range(1)
    assert one.select(next_sk(df, "sk").alias("n")).first().n == 10
    assert one.select(next_sk(df.limit(0), "sk").alias("n")).first().n == 1


def test_null_conditions_change_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k INT, v STRING")
    changed = update_where(df, F.col("k") == 1, {"v": F.lit("z")})
    assert [r.v for r in changed.collect()] == ["z", "b", "c"]
    assert [r.v for r in delete_where(df, F.col("k") == 1).collect()] == ["b", "c"]
