import os
import tempfile

import pytest

from tests.conftest import SF001
from tidemark.sources.panel_io import (alignment_report, load_model, read_panel, save_model,
                                       write_predictions)


def test_csv_nan_becomes_null_and_alignment(spark):
    d = tempfile.mkdtemp(prefix="tm-csv-", dir="/tmp")
    tr, te = os.path.join(d, "train.csv"), os.path.join(d, "test.csv")
    with open(tr, "w") as fh:
        fh.write("row_id,date_id,D1,E1,forward_returns\n0,1,1,0.5,0.1\n1,2,-1,NaN,0.2\n2,3,0,,0.3\n")
    with open(te, "w") as fh:
        fh.write("row_id,date_id,D1,E1,extra\n9,4,1,NaN,7\n")
    train = read_panel(spark, tr)
    assert train.where("E1 IS NULL").count() == 2
    rep = {(r["column_name"], r["side"]) for r in alignment_report(train, read_panel(spark, te)).collect()}
    assert rep == {("forward_returns", "train"), ("extra", "test")}
    assert dict(train.dtypes)["D1"] == "int"


def test_prediction_sink_and_model_roundtrip(spark):
    from pyspark.ml.regression import LinearRegression

    from tidemark.operators.select import assemble

    d = tempfile.mkdtemp(prefix="tm-sink-", dir="/tmp")
    preds = spark.createDataFrame([(1, 0.5, "ridge"), (2, -0.1, "ridge"), (1, 0.2, "gbt")],
                                  "row_id long, prediction double, model string")
    path = write_predictions(preds, os.path.join(d, "preds"))
    back = spark.read.parquet(path)
    assert back.where("model = 'ridge'").count() == 2
    assert "market_forward_excess_returns" in back.columns
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    model = LinearRegression(labelCol="y").fit(assemble(df, ["x"], keep=["y"]))
    mp = save_model(model, os.path.join(d, "lr"))
    again = load_model(spark, mp)
    assert abs(again.coefficients[0] - model.coefficients[0]) < 1e-12


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "value_rmean3" in df.columns
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", ["roll_daily", "profile_missing_events", "blend_equal_daily"])
def test_queries_run_on_smallest_scale(spark, name):
    import __spark_entry__ as entry

    assert entry.queries()[name](spark, SF001).count() > 0


def test_stage_table_sinks_round_trip(spark):
    """Stage tables and a metrics table written and read back."""
    from tidemark.config import PanelSpec
    from tidemark.plans.preprocess import preprocess
    from tidemark.sources.fixtures import events_nulls, split_by_time
    from tidemark.sources.panel_io import write_table

    d = tempfile.mkdtemp(prefix="tm-stage-", dir="/tmp")
    tr, te = split_by_time(events_nulls(spark, SF001))
    spec = PanelSpec(target="value", ids=("event_id", "user_id"), leakage=(), order=("ts",))
    pp = preprocess(tr, te, spec, "robust", out_dir=d)
    back = spark.read.parquet(os.path.join(d, "train_preprocessed"))
    assert back.count() == tr.count() and set(back.columns) == set(pp.train.columns)
    csv = write_table(pp.scaler.table(spark), os.path.join(d, "scaler_csv"), fmt="csv")
    assert spark.read.option("header", True).csv(csv).count() == len(pp.scaler.params)


def test_ranges_reach_the_scan(spark, tmp_path):
    from tidemark.sources.panel_io import read_table

    rows = [(1, 0.5), (2, float("nan")), (3, None), (4, 7.0), (5, 9.0)]
    spark.createDataFrame(rows, "id long, x double").write.parquet(str(tmp_path / "t.parquet"))
    for ranges, want in (({"x": (1.0, None)}, [4, 5]), ({"x": (None, 7.0)}, [1, 4]), ({"x": (1.0, 8.0), "id": (4, 4)}, [4])):
        df = read_table(spark, str(tmp_path), "t", ranges)
        assert sorted(r.id for r in df.collect()) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):].split("]")[0]
        assert "ThanOrEqual(x," in pushed
