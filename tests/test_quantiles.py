import math
import random

import numpy as np
import pytest

from profilelake.operators.aggregate import first_rows, group_mean, quantile_limits

Q = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
NAMES = tuple(f"q{i}" for i in range(len(Q)))


def cases():
    rng = random.Random(11)
    yield "one", [3.25]
    yield "two", [-1.0, 1.0]
    yield "uniform", [rng.random() for _ in range(3000)]
    yield "signs and sizes", [
        rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(3000)
    ]
    yield "third in one value", [0.1] * 1000 + [rng.gauss(0.1, 1e-9) for _ in range(2000)]
    yield "zeros", [0.0, -0.0] * 500 + [1e-320, -1e-320]
    yield "powers of two", [2.0 ** rng.randint(-40, 40) * rng.choice([-1, 1]) for _ in range(2000)]
    yield "neighbours", [1.0 + i * 2.0**-52 for i in range(2000)]


@pytest.mark.parametrize("kind", ["double", "float"])
@pytest.mark.parametrize("name, values", list(cases()), ids=[n for n, _ in cases()])
def test_exact(spark, name, values, kind):
    if kind == "float":
        values = [float(np.float32(v)) for v in values if abs(v) < 1e38]
    rng = random.Random(5)
    shuffled = values + [None, float("nan")] * 20
    rng.shuffle(shuffled)
    df = spark.createDataFrame([(v,) for v in shuffled], f"v {kind}").repartition(5)
    expected = np.quantile(np.array(values, dtype=float), Q)
    for rows_per_range in (1_000_000, 20):
        got = quantile_limits(df, "v", Q, NAMES, rows_per_range=rows_per_range).first()
        for x, y in zip(got, expected):
            assert math.isclose(x, y, rel_tol=1e-12, abs_tol=0), (x, y)


def test_infinite_values_and_integers(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, inf, inf]], "v double")
    assert tuple(quantile_limits(df, "v", (0, 0.5, 1), ("a", "b", "c")).first()) == (-inf, 2, inf)
    numbers = spark.range(101)
    assert tuple(quantile_limits(numbers, "id", (0.01, 0.995)).first()) == (1.0, 99.5)


def test_no_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert tuple(quantile_limits(df, "v").first()) == (None, None)


def test_approximate(spark):
    df = spark.range(100001).selectExpr("cast(id as double) as v")
    low, high = quantile_limits(df, "v", approximate=True).first()
    assert abs(low - 1000) <= 20 and abs(high - 99000) <= 20


def test_group_mean(spark):
    nan = float("nan")
    rows = [
        (1.0, 2.0, 1.0), (1.0, 2.0, None), (1.0, 2.0, nan), (1.0, 2.0, 4.0),
        (1.0, 3.0, nan), (None, 2.0, 9.0), (nan, 2.0, 9.0), (0.0, 0.0, 1.0), (-0.0, 0.0, 3.0),
    ]
    df = spark.createDataFrame(rows, "LATITUDE double, LONGITUDE double, CHLA float")
    got = {(r.LATITUDE, r.LONGITUDE): r.CHLA for r in group_mean(df, "CHLA").collect()}
    assert got == {(1.0, 2.0): 2.5, (1.0, 3.0): None, (0.0, 0.0): 2.0}
    assert group_mean(df, ["CHLA"], ["LATITUDE"]).count() == 2


def test_first_rows(spark):
    df = spark.range(100)
    assert first_rows(df).count() == 5
    assert [r.id for r in first_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
