import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.quantiles import quantile_map


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.RandomState(1)
    a = rng.normal(size=301).round(1)  # many ties
    b = np.where(rng.rand(301) < 0.3, np.nan, rng.exponential(size=301))
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double")
    qm = quantile_map(df, ["a", "b"], [0.25, 0.5, 0.75])
    for c in ("a", "b"):
        vals = pdf[c].dropna().to_numpy()
        for q in (0.25, 0.5, 0.75):
            assert abs(qm[(c, q)] - np.percentile(vals, q * 100)) < 1e-12


def test_hot_value_third_of_rows(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0))
                                     .otherwise(F.col("id").cast("double")).alias("x"))
    vals = np.array([5.0 if i % 3 == 0 else float(i) for i in range(3000)])
    qm = quantile_map(df, ["x"], [0.1, 0.5, 0.9])
    for q in (0.1, 0.5, 0.9):
        assert abs(qm[("x", q)] - np.percentile(vals, q * 100)) < 1e-9


def test_all_null_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    qm = quantile_map(df, ["a", "b"], [0.5])
    assert ("a", 0.5) not in qm and qm[("b", 0.5)] == 1.5


def test_counting_equals_sorting(spark):
    from tidemark.operators.quantiles import order_values, quantiles

    rng = np.random.RandomState(3)
    n = 4000
    spread = 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1, 1], n)
    near = 1.0 + rng.randint(0, 50, n) * 2.0 ** -52
    pdf = pd.DataFrame({"spread": spread, "near": near, "ints": rng.randint(-5, 6, n).astype(float),
                        "big": 1e15 + rng.randint(0, 10 ** 6, n), "normal": rng.normal(size=n),
                        "ends": rng.choice([np.inf, -np.inf, 0.0, -0.0, 5e-324], n)})
    df = spark.createDataFrame(pdf).repartition(5)
    cols = list(pdf.columns)
    got = order_values(df, cols, lambda n: range(0, n, 7))
    for c in cols:
        want = np.sort(pdf[c].to_numpy())
        assert got[c][0] == n
        assert all(got[c][1][r] == want[r] for r in range(0, n, 7))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    key = lambda d: {(r.column_name, r.q): r.value for r in d.collect()}
    plain = [c for c in cols if c != "ends"]
    assert key(quantiles(df, plain, probs)) == key(quantiles(df, plain, probs, method="sorted"))


def test_counting_shuffles_no_rows(spark):
    from tidemark.operators.quantiles import counting_pass

    rows = spark.range(1000).selectExpr("0 as slot", "cast(id % 7 as int) as part", "cast(id as double) as x",
                                        "false as few")
    plan = counting_pass(rows)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1 and "partial_count" in below and "rangepartitioning" not in plan


def test_counting_empty_and_nan(spark):
    from tidemark.operators.quantiles import order_values

    df = spark.createDataFrame([(float("nan"), None), (3.0, None), (None, None)], "a double, b double")
    assert order_values(df, ["a", "b"], lambda n: [0]) == {"a": (1, {0: 3.0})}
    assert order_values(df.limit(0), ["a"], lambda n: [0]) == {}
