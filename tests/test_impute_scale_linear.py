import numpy as np
import pytest

from tidemark.config import PanelSpec
from tidemark.operators import impute, linear, scale

SPEC = PanelSpec(target="y", ids=("id",), leakage=(), order=("id",))


def _train(spark):
    # a: 50 % missing (dropped), b: 20 % missing (flag + median), c: 10 % (median)
    rows = []
    for i in range(10):
        rows.append((i, None if i < 5 else float(i), None if i < 2 else float(i * 2),
                     None if i < 1 else float(i), float(i), 1 if i % 2 else -1))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, f int")


def test_tier_imputer(spark):
    tr = _train(spark)
    imp = impute.TierImputer(SPEC).fit(tr)
    assert imp.drop_cols == ["a"] and imp.flag_cols == ["b"] and imp.fill_cols == ["c"]
    assert imp.medians["b"] == np.median([i * 2 for i in range(2, 10)])
    test = spark.createDataFrame([(100, None, None, None, 0.0, 1)], tr.schema)
    row = imp.transform(test).first()
    assert "a" not in row.asDict() and row["b_was_null"] == 1
    assert row["b"] == imp.medians["b"] and row["c"] == imp.medians["c"]
    assert imp.meta.binary == ["f"]


def test_test_frame_missing_column(spark):
    tr = _train(spark)
    imp = impute.TierImputer(SPEC).fit(tr)
    out = imp.transform(tr.drop("b"))
    assert "b_was_null" not in out.columns and out.count() == 10


@pytest.mark.parametrize("method", ["robust", "standard", "minmax"])
def test_scalers_zero_spread_and_roundtrip(spark, method):
    rows = [(float(i), 3.0) for i in range(9)]
    df = spark.createDataFrame(rows, "x double, k double")
    sc = scale.Scaler(method).fit(df, ["x", "k"])
    assert sc.params["k"][1] == 1.0
    out = sc.transform(df).toPandas()
    back = sc.inverse(sc.transform(df)).toPandas()
    assert np.allclose(back["x"], [float(i) for i in range(9)])
    x = np.arange(9.0)
    if method == "robust":
        exp = (x - np.median(x)) / (np.percentile(x, 75) - np.percentile(x, 25))
    elif method == "standard":
        exp = (x - x.mean()) / x.std()
    else:
        exp = (x - x.min()) / (x.max() - x.min())
    assert np.allclose(out["x"], exp)


def test_unknown_scaler_raises():
    with pytest.raises(ValueError):
        scale.Scaler("zscore")


def test_ridge_moments_match_numpy_and_spark_lr(spark):
    rng = np.random.RandomState(7)
    n, p = 300, 3
    X = rng.normal(size=(n, p)) * [1.0, 5.0, 0.2] + 3.0
    y = X @ [1.0, -0.5, 2.0] + rng.normal(size=n) + 10.0
    rows = [(i, *map(float, X[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "i long, a double, b double, c double, y double")
    mom, shift = linear.segment_moments(df, ["a", "b", "c"], "y", None)
    alpha = 25.0
    fit = linear.ridge_from_moments(mom[0], alpha, shift)
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(p), Xc.T @ yc)
    assert np.allclose(fit.coef, beta, atol=1e-10)
    assert np.isclose(fit.intercept, y.mean() - X.mean(0) @ beta)

    from tidemark.operators.select import assemble
    from tidemark.operators.trees import make_estimator, ridge_reg_param

    reg = ridge_reg_param(alpha, n, float(y.std()))
    lr = make_estimator("ridge", {"regParam": reg}).setLabelCol("y")
    model = lr.fit(assemble(df, ["a", "b", "c"], keep=["y"]))
    assert np.allclose(model.coefficients.toArray(), beta, atol=1e-8)


def test_loo_alpha_matches_refits(spark):
    rng = np.random.RandomState(2)
    n = 40
    x = rng.normal(size=n)
    y = 0.7 * x + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    alphas = [0.01, 1.0, 100.0]
    _, _, scores = linear.loo_alpha(df, ["x"], "y", alphas)
    for a, mse in scores:
        errs = []
        for i in range(n):
            m = np.ones(n, bool)
            m[i] = False
            xm, ym = x[m].mean(), y[m].mean()
            b = np.sum((x[m] - xm) * (y[m] - ym)) / (np.sum((x[m] - xm) ** 2) + a)
            errs.append((y[i] - (ym + b * (x[i] - xm))) ** 2)
        assert np.isclose(mse, np.mean(errs), rtol=1e-9)


def test_alpha_path_r2_matches_refit(spark):
    rng = np.random.RandomState(5)
    n = 120
    x = rng.normal(size=n) * 3
    y = 2 * x + rng.normal(size=n)
    seg = [0 if i < 20 else 1 + (i - 20) // 20 for i in range(n)]
    df = spark.createDataFrame([(int(s), float(a), float(b)) for s, a, b in zip(seg, x, y)],
                               "seg int, x double, y double")
    mom, shift = linear.segment_moments(df, ["x"], "y", "seg")
    best, path = linear.alpha_path(mom, [1.0, 1e3], shift)
    seg = np.array(seg)
    for a, r2 in path:
        scores = []
        for f in range(1, 6):
            tr, va = seg < f, seg == f
            xm, ym = x[tr].mean(), y[tr].mean()
            b = np.sum((x[tr] - xm) * (y[tr] - ym)) / (np.sum((x[tr] - xm) ** 2) + a)
            pred = ym + b * (x[va] - xm)
            scores.append(1 - np.sum((y[va] - pred) ** 2) / np.sum((y[va] - y[va].mean()) ** 2))
        assert np.isclose(r2, np.mean(scores))
    assert best == 1.0
