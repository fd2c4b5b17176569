"""Property tests (hypothesis): a few examples each, every one a Spark job."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.ordered import rolling_features

SETTINGS = dict(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(n=st.integers(12, 60), bucket=st.integers(9, 25), seed=st.integers(0, 10_000))
def test_halo_equals_global_for_any_bucket(spark, n, bucket, seed):
    rng = np.random.RandomState(seed)
    v = rng.normal(size=n).round(2)
    df = spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(v)], "t long, v double")
    got = rolling_features(df, ["v"], order=["t"], lags=(1, 3), bucket_size=bucket).toPandas()
    got = got.sort_values("t")
    s = pd.Series(v)
    np.testing.assert_allclose(got["v_rmean10"], s.rolling(10, min_periods=1).mean(), rtol=1e-9)
    np.testing.assert_allclose(got["v_rstd5"], s.rolling(5, min_periods=1).std().fillna(0),
                               rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(got["v_lag3"], s.shift(3).fillna(s.mean()), rtol=1e-9)


@settings(**SETTINGS)
@given(scores=st.lists(st.floats(-1, 1, allow_nan=False), min_size=2, max_size=5))
def test_blend_weights_sum_to_one(spark, scores):
    from tidemark.operators.blend import sharpe_weights

    names = [f"m{i}" for i in range(len(scores))]
    t = spark.createDataFrame(list(zip(names, scores)), "model string, mean_sharpe double")
    row = sharpe_weights(t, names).first()
    w = [row[f"w_{m}"] for m in names]
    assert abs(sum(w) - 1.0) < 1e-12 and min(w) >= 0


@settings(**SETTINGS)
@given(vals=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=3, max_size=30),
       method=st.sampled_from(["robust", "standard", "minmax"]))
def test_scaler_inverse_round_trips(spark, vals, method):
    from tidemark.operators.scale import Scaler

    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    sc = Scaler(method).fit(df, ["x"])
    back = [r[0] for r in sc.inverse(sc.transform(df)).collect()]
    assert np.allclose(back, vals, rtol=1e-9, atol=1e-6)
