import os
import tempfile

import numpy as np

from tests.conftest import SF001
from tidemark.operators.impute import TierImputer
from tidemark.sources.fixtures import panel
from tidemark.streaming.scoring import score_rows, zscore_batch_stats


def test_stream_scoring_equals_batch(spark):
    p = panel(spark, SF001).drop("target")
    train = p.where("date_id < 400")
    test = p.where("date_id >= 400")
    stats = zscore_batch_stats(train)
    d = tempfile.mkdtemp(prefix="tm-stream-", dir="/tmp")
    src = os.path.join(d, "in")
    test.write.parquet(src)
    stream = spark.readStream.schema(test.schema).parquet(src)
    q = (score_rows(stream, batch_stats=stats).writeStream.format("memory")
         .queryName("tm_scored").option("checkpointLocation", os.path.join(d, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM tm_scored").toPandas().sort_values("row_id").reset_index(drop=True)
    exp = score_rows(test, batch_stats=stats).toPandas().sort_values("row_id").reset_index(drop=True)
    assert len(got) == len(exp) == 100
    for c in ("E_mean", "V_top_rank", "E_zscore_mean", "IR_M_sq", "D_signal"):
        assert np.allclose(got[c].astype(float), exp[c].astype(float), equal_nan=True), c
    assert TierImputer  # imported API surface


def test_preprocess_and_modeling_plans(spark):
    from tidemark.config import PanelSpec
    from tidemark.operators.trees import make_estimator
    from tidemark.plans.modeling import evaluate
    from tidemark.plans.preprocess import preprocess
    from tidemark.sources.fixtures import daily_eval, events_nulls, split_by_time

    en = events_nulls(spark, SF001)
    tr, te = split_by_time(en)
    spec = PanelSpec(target="value", ids=("event_id", "user_id"), leakage=(), order=("ts",))
    pp = preprocess(tr, te, spec, "standard")
    assert "high_null" not in pp.train.columns and "mid_null_was_null" in pp.test.columns
    assert pp.train.where("low_null IS NULL OR mid_null IS NULL").count() == 0

    ev = daily_eval(spark, SF001).select("date_id", "seg", "y", "x1", "x2", "x3")
    res = evaluate(ev, ["x1", "x2", "x3"], "y", "date_id", {
        "ridge": (lambda: make_estimator("ridge", {"regParam": 0.01}), False),
        "gbt": (lambda: make_estimator("gbt", {"n_estimators": 3, "max_depth": 2}), False),
    })
    assert res.per_fold.count() == 10
    assert res.board.count() == 2
    assert res.blends.select("blend", "blend_equal", "stacked").count() == ev.count()
