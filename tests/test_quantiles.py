"""Both ways to an exact quantile, against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quantiles
from ledgerloom.operators.quantiles import exact_quantiles

WANTED = [0.0, 1 / 3, 0.5, 2 / 3, 0.9, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 101, 1000])
@pytest.mark.parametrize("bracketed", [False, True])
def test_small_columns(spark, size, bracketed):
    values = np.random.default_rng(size).normal(size=size).round(3)
    got = [m.value for m in exact_quantiles(frame(spark, values), "x", WANTED, bracketed)]
    assert got == pytest.approx([np.quantile(values, p) for p in WANTED])


@pytest.mark.parametrize("shape", ["normal", "hot_value", "two_values", "constant", "huge_spread", "tiny", "both_signs"])
def test_passes_find_the_rows_whatever_the_shape(spark, monkeypatch, shape):
    """Digits of 8 bits, so that 5,000 rows take several passes."""
    monkeypatch.setattr(quantiles, "CELLS", 256)
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=5000),
        "hot_value": np.where(rng.random(5000) < 0.4, 0.25, rng.normal(size=5000)),
        "two_values": np.where(rng.random(5000) < 0.5, 1.0, 2.0),
        "constant": np.full(5000, 4.0),
        "huge_spread": np.exp(rng.normal(size=5000) * 20),
        "tiny": rng.integers(-50, 50, 5000) * 5e-324,
        "both_signs": np.concatenate([rng.normal(size=2498) * 1e-300, -np.exp(rng.normal(size=2498) * 200), [0.0, -0.0, 1.7976931348623157e308, 2.2250738585072014e-308]]),
    }[shape]
    got = exact_quantiles(frame(spark, values), "x", WANTED, bracketed=True)
    want = np.sort(values)
    for p, m in zip(WANTED, got, strict=True):
        assert (m.low, m.high) == tuple(want[quantiles._place(len(want), p)[i]] for i in (0, 1)) and m.rows == 5000


def test_bits_order_as_values_do_and_lead_back(spark):
    rng = np.random.default_rng(4)
    some = rng.integers(-(2**63), 2**63 - 1, 4000).view(np.float64)
    edges = [2.0**e * f for e in (-1074, -1073, -1023, -1022, -1021, -1, 0, 1, 52, 53, 1023) for f in (1, 1 - 2**-53, 1 + 2**-52)]
    values = np.array([v for v in [*some.tolist(), *edges, *(-np.array(edges))] if v == v])
    rows = quantiles._with_bits(frame(spark, values).withColumnRenamed("x", "v")).collect()
    assert len(rows) == len(values) and all(quantiles._double(r.b) == r.v for r in rows)


def test_infinite_values_are_the_ends(spark):
    got = exact_quantiles(frame(spark, [1.0, float("inf"), -float("inf"), 2.0]), "x", [0.0, 1.0])
    assert [m.low for m in got] == [-float("inf"), float("inf")]


@pytest.mark.parametrize("bracketed", [False, True])
def test_missing_values_do_not_count(spark, bracketed):
    df = frame(spark, [1.0, 2.0, 3.0, float("nan")]).union(
        spark.range(1).select(F.lit(None).cast("double"))
    )
    (middle,) = exact_quantiles(df, "x", [0.5], bracketed)
    assert middle.value == 2.0 and middle.rows == 3
    assert exact_quantiles(df.where("x > 9 and not isnan(x)"), "x", [0.5], bracketed) == [None]
