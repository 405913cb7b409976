"""Exact quantile cuts, top-k and paging."""

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from tillhouse.operators.ranking import label_segments, page, rank_cuts, top_k


def cuts(spark, values, parts, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "v DECIMAL(28,2)").repartition(5)
    return [x for x in rank_cuts(df, "v", parts, accuracy)]


@pytest.mark.parametrize("parts", [2, 3, 4])
@pytest.mark.parametrize("n,accuracy,kind", [
    (1, 100, "even"), (2, 100, "even"), (7, 100, "even"), (399, 100, "even"), (401, 100, "even"),
    (5000, 100, "even"), (5000, 100, "tied"), (5000, 100, "hot"), (6001, 1000, "long"), (3000, 2, "long"), (900, 64, "huge"),
])
def test_cuts_are_exact(spark, parts, n, accuracy, kind):
    rng = random.Random(n + parts)
    draw = {
        "even": lambda: rng.randrange(10_000_000) / 100,
        "tied": lambda: rng.randrange(5) / 100,
        "hot": lambda: 5.0 if rng.random() < 0.4 else rng.randrange(100_000) / 100,
        "long": lambda: round(rng.lognormvariate(0, 3), 2),
        # Neighbours that doubles can not tell apart.
        "huge": lambda: Decimal(10**24 + rng.randrange(400)) / 100,
    }[kind]
    values = [Decimal(f"{draw():.2f}") for _ in range(n)]
    ranked = sorted(values)
    expected = [ranked[i * (n - 1) // parts] for i in range(1, parts)]
    assert cuts(spark, values, parts, accuracy) == expected


def test_segments_match_quantile_cut(spark):
    rng = np.random.default_rng(3)
    spend = pd.Series(rng.permutation(np.arange(1, 1260)) * 1.5)
    labels = ["Low", "Medium", "High"]
    expected = pd.qcut(spend, q=3, labels=labels).value_counts().to_dict()
    df = spark.createDataFrame([(float(v),) for v in spend], "v DOUBLE")
    found = {r.segment: r["count"] for r in label_segments(df, "v", labels).groupBy("segment").count().collect()}
    assert found == expected


def test_segments_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "v DOUBLE")
    assert label_segments(empty, "v", ["Low", "High"]).count() == 0
    same = spark.createDataFrame([(2.0,)] * 5 + [(None,)], "v DOUBLE")
    assert {r.segment for r in label_segments(same, "v", ["Low", "Mid", "High"]).collect()} == {"Low", None}


def test_top_k_puts_null_first(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 3)], "k STRING, v INT")
    assert [r.k for r in top_k(df, "v", 3, ["k"]).collect()] == ["b", "c", "d"]


def test_pages_do_not_overlap(spark):
    df = spark.range(103).repartition(4)
    seen = [r.id for i in range(0, 110, 10) for r in page(df, ["id"], 10, i).collect()]
    assert seen == list(range(103))
