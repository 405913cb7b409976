import numpy as np
import pytest

from tillhouse.operators.histogram import histogram


@pytest.mark.parametrize("bins", [1, 30, 40])
@pytest.mark.parametrize("kind", ["money", "whole", "edges", "same", "empty"])
def test_against_numpy(spark, bins, kind):
    rng = np.random.default_rng(bins)
    values = {
        "money": np.round(rng.lognormal(5, 1, 3000), 2),
        "whole": rng.integers(-50, 50, 2000).astype(float),
        "edges": np.repeat(np.linspace(0, 3, 31), 3),
        "same": np.full(10, 7.25),
        "empty": np.array([]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v DOUBLE")
    counts, edges = np.histogram(values, bins=bins)
    rows = histogram(df, "v", bins).orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert np.allclose([r.bin_start for r in rows], edges[:-1], rtol=1e-12, atol=1e-12)
    assert np.allclose([r.bin_end for r in rows], edges[1:], rtol=1e-12, atol=1e-12)


def test_label_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (2.5,)], "v DOUBLE")
    assert histogram(df, "v", 1).first().bin_label == "0–2"
