import numpy as np
import pytest

from cinderspark.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_quantiles(spark, accuracy):
    rng = np.random.default_rng(6)
    groups = {"one": [3.0], "two": [1.0, 2.0], "ties": [0.0] * 900 + [1.0] * 100, "many": rng.exponential(size=3000).tolist(), "few": rng.normal(size=40).tolist(), None: [5.0, 6.0, 9.0]}
    rows = [(k, v, -v if i % 3 else None) for k, vs in groups.items() for i, v in enumerate(vs)] + [("nan", float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    qs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["g"]: (r["a_q"], r["b_q"]) for r in exact_quantiles(df, ["g"], ["a", "b"], qs, accuracy).collect()}
    assert got.pop("nan") == ([None] * len(qs), [None] * len(qs))
    assert set(got) == set(groups)
    for k, vs in groups.items():
        other = [-v for i, v in enumerate(vs) if i % 3]
        assert got[k][0] == pytest.approx(np.quantile(vs, qs).tolist(), abs=1e-12)
        assert got[k][1] == (pytest.approx(np.quantile(other, qs).tolist(), abs=1e-12) if other else [None] * len(qs))
    whole = exact_quantiles(df.where("g is not null"), [], ["a"], [0.5], accuracy).first()["a_q"]
    assert whole == [pytest.approx(np.median([v for k, vs in groups.items() if k for v in vs]), abs=1e-12)]
