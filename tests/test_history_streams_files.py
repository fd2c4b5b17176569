"""Past means over train and test, arriving rows, files of several models, damaged rows."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import rolling_features
from tidemark.sources.panel_io import read_checked, write_predictions
from tidemark.streaming.rolling import feature_names, rolling_stream


def keyed_rows(n=90, seed=1):
    rng = np.random.RandomState(seed)
    pdf = pd.DataFrame({"k": rng.choice(["a", "a", "a", "b", "c"], n), "t": np.arange(n),
                        "v": np.where(rng.rand(n) < 0.25, np.nan, rng.normal(size=n).round(3)),
                        "w": np.repeat([2.0, 5.0], n // 2)})
    return pdf


def sdf(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, t long, v double, w double")


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("strategy", ["halo", "key"])
def test_past_mean_carries_the_history(spark, keys, strategy):
    if strategy == "key" and not keys:
        pytest.skip("the key strategy needs a key")
    pdf = keyed_rows()
    pdf.loc[pdf["t"] >= 60, "k"] = pdf.loc[pdf["t"] >= 60, "k"].replace("c", "new")  # a key without history
    df = sdf(spark, pdf)
    cut = 60
    got = rolling_features(df.where(f"t >= {cut}"), ["v"], ["t"], keys, windows=(), lags=(1, 2, 3),
                           lag_fill="past_mean", rolling=False, strategy=strategy, bucket_size=4,
                           history=df.where(f"t < {cut}")).toPandas().sort_values("t")
    groups = pdf.groupby("k") if keys else [("", pdf)]
    want = []
    for _, g in groups:
        past = g["v"].expanding().mean().shift(1).ffill()
        want.append(pd.DataFrame({"t": g["t"], **{f"v_lag{j}": g["v"].shift(j).fillna(past) for j in (1, 2, 3)}}))
    want = pd.concat(want).sort_values("t")
    want = want[want["t"] >= cut]
    for j in (1, 2, 3):
        np.testing.assert_allclose(got[f"v_lag{j}"].astype(float), want[f"v_lag{j}"], atol=1e-9)
    assert set(got.columns) == {"k", "t", "v", "w", "v_lag1", "v_lag2", "v_lag3"}


@pytest.mark.parametrize("fill", [None, "past_mean"])
@pytest.mark.parametrize("cuts", [(1, 7, 8, 50), (30,)])
def test_arriving_rows_equal_batch(spark, fill, cuts):
    pdf = keyed_rows(80)
    df = sdf(spark, pdf)
    d = tempfile.mkdtemp(prefix="tm-roll-", dir="/tmp")
    src = os.path.join(d, "in")
    os.makedirs(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(src)
    name = f"rolled_{len(cuts)}_{fill}"
    out = rolling_stream(stream, ["v", "w"], "t", ["k"], lag_fill=fill)
    q = out.writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", os.path.join(d, "ck")).start()
    try:
        for i, part in enumerate(np.split(pdf, list(cuts))):
            part.sample(frac=1.0, random_state=i).to_json(
                os.path.join(src, f"{i}.json"), orient="records", lines=True)
            q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table(name).toPandas().sort_values("t").reset_index(drop=True)
    want = rolling_features(df, ["v", "w"], ["t"], ["k"], lag_fill=fill).toPandas().sort_values("t").reset_index(drop=True)
    assert len(got) == 80
    for c in feature_names(["v", "w"]):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-6, err_msg=c)


def test_predictions_of_two_models_stay(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tm-pred-", dir="/tmp"), "p")
    one = spark.createDataFrame([(1, 0.1, "A"), (2, 0.2, "A")], "row_id long, prediction double, model string")
    write_predictions(one, path)
    write_predictions(one.withColumn("model", F.lit("B")), path)
    write_predictions(one.limit(1), path)  # A again, one row
    got = {r.model: r.n for r in spark.read.parquet(path).groupBy("model").agg(F.count("*").alias("n")).collect()}
    assert got == {"A": 1, "B": 2}


def test_damaged_rows_are_counted(spark):
    d = tempfile.mkdtemp(prefix="tm-csv-", dir="/tmp")
    for name, body in (("x.csv", "id,a,b\n1,2.5,3\n2,oops,4\n3,1.0\n4,,7\n5,1.5,NaN\n6,1,2,3\n"), ("y.csv", "id,a,b\n7,1,1\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    panel, rejected, report = read_checked(spark, d, "id long, a double, b double")
    assert sorted((r.id, r.a, r.b) for r in panel.collect()) == [(1, 2.5, 3.0), (4, None, 7.0), (5, 1.5, None), (7, 1.0, 1.0)]
    assert sorted(r.text for r in rejected.collect()) == ["2,oops,4", "3,1.0", "6,1,2,3"]
    assert {os.path.basename(r.file): (r.rows, r.accepted, r.rejected) for r in report.collect()} == {
        "x.csv": (6, 3, 3), "y.csv": (1, 1, 0)}
