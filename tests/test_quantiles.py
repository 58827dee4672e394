import numpy as np
import pytest

from ledgerlens.functions.quantiles import exact_quantiles, kth_largest, numeric_profile

PROBS = [0.0, 0.25, 0.5, 0.999, 1.0]


def shapes():
    rng = np.random.default_rng(7)
    yield "normal", rng.normal(size=5000)
    yield "heavy tail", rng.pareto(0.5, size=5000)
    yield "one hot value", np.where(rng.random(5000) < 0.4, 3.25, rng.normal(size=5000))
    yield "few values", rng.integers(0, 4, size=5000).astype(float)
    yield "constant", np.full(3000, 2.0)
    yield "one row", np.array([4.5])


@pytest.mark.parametrize("direct_rows", [20, 10_000])
@pytest.mark.parametrize("name,values", list(shapes()))
def test_equal_to_linear_quantiles(spark, name, values, direct_rows):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    found = exact_quantiles(df, ["x"], PROBS, direct_rows)["x"]
    assert np.allclose(found, np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)


def test_nulls_and_nans_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    profile = numeric_profile(df, ["x"])["x"]
    assert (profile.count, profile.mean, profile.quantiles[0.5]) == (2, 2.0, 2.0)


def test_no_values_give_no_quantiles(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


@pytest.mark.parametrize("direct_rows", [10, 10_000])
def test_kth_largest(spark, direct_rows):
    values = np.random.default_rng(3).integers(0, 300, size=2000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 17, 1000, 2000):
        assert kth_largest(df, "x", k, direct_rows) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "x", 2001, direct_rows) is None
