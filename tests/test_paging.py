"""Pages by index, range clustering, and malformed lines."""

from pyspark.sql import functions as F

from tillhouse.operators.paging import build_pages, open_pages
from tillhouse.sources import raw as sources
from tillhouse.sources import sinks


def rows(df):
    return sorted(df.collect(), key=str)


def test_pages_read_their_ranges_and_together_are_the_table(spark, tmp_path, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(0, 5000, 1, 6).select(F.when(F.col("id") > 4990, None).otherwise(F.format_string("k%05d", "id")).alias("k"), "id")
    pages = build_pages(df, ["k", "id"], str(tmp_path))
    assert pages.index.count() > 4
    whole = [tuple(r) for r in df.orderBy(F.col("k").asc_nulls_last(), "id").collect()]
    for pages in (pages, open_pages(spark, str(tmp_path), ["k", "id"])):
        seen = [tuple(r) for at in range(0, 5200, 400) for r in pages.page(400, at).select("k", "id").collect()]
        assert seen == whole
    plan = pages.page(10, 2500)._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    numbered = {(r.k, r.id): r.page for r in pages.numbered(400).collect()}
    assert numbered == {row: i // 400 for i, row in enumerate(whole)}
    assert pages.page(10, 9999).count() == 0


def test_a_busy_day_is_split_and_files_follow_each_other(spark, tmp_path, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    day = F.when(F.col("id") % 2 == 0, 20240115).otherwise(20240101 + F.col("id") % 28).cast("int")
    fact = spark.range(0, 20_000, 1, 4).select(
        F.format_string("I%05d", "id").alias("order_item_id"), day.alias("date_sk"), F.lit("x").alias("order_status")
    )
    sinks.write_fact(fact, str(tmp_path / "fact"), sinks.RANGE)
    spans = sinks.file_spans(spark.read.parquet(str(tmp_path / "fact")))
    assert spans.filter("first = 20240115 AND last = 20240115").count() >= 2
    (month,) = sinks.month_spans(spans).collect()
    assert (month.n, month.first_day, month.last_day, month.overlaps) == (20_000, 20240102, 20240128, 0)
    mixed = spark.createDataFrame([(202401, "a", 1, 1, 9), (202401, "b", 1, 5, 6), (202402, "c", 1, 2, 2)], "year_month int, file string, n long, first int, last int")
    assert {r.year_month: r.overlaps for r in sinks.month_spans(mixed).collect()} == {202401: 1, 202402: 0}


def test_malformed_lines(spark, tmp_path, as_of):
    (tmp_path / "o.csv").write_text('order_id,customer_code,order_date,status,order_city,order_state\nO1,C1,d,PLACED,Pune,MH\nO2,C1,d,PLACED,Pune\n'
                                    'O3,C1,d,PLACED,Pune,MH,more\nO4,"C,4",d,PLACED,,\n\n')
    read, malformed = sources.read_checked(spark, str(tmp_path / "o.csv"), "orders")
    assert rows(read) == [("O1", "C1", "d", "PLACED", "Pune", "MH"), ("O4", "C,4", "d", "PLACED", None, None)]
    assert sorted(r.line for r in malformed.collect()) == ["O2,C1,d,PLACED,Pune", "O3,C1,d,PLACED,Pune,MH,more"]
    found = sources.malformed_rejects(malformed, as_of).collect()
    assert {r.reason for r in found} == {"malformed_row"} and '{"line":"O2,C1,d,PLACED,Pune"}' in {r.row_data for r in found}
    (tmp_path / "m.csv").write_text('order_id,customer_code,order_date,status,order_city,order_state\nO1,"C\n1",d,PLACED,Pune,MH\n')
    read, malformed = sources.read_checked(spark, str(tmp_path / "m.csv"), "orders", multi_line=True)
    assert [r.customer_code for r in read.collect()] == ["C\n1"] and malformed.count() == 0
