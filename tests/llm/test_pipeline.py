"""Stages of the corpus pipeline on planted rows, edge rows and against direct versions."""

import os
import random
import re
import tempfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, licenses, packing, pii, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    """A folder of the three tables: clean texts, toxic ones, near copies, a leaked item, personal data."""
    rng = random.Random(9)
    vocab = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("ado", "emi", "ira", "olu", "une", "asti")]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows, labels = [], []
    for i in range(1, 261):
        bad = i % 4 == 0
        rows.append((i, text(60) + (" grobiknave wrelchtoad " + text(20) if bad else " " + text(20))))
        if i <= 240:
            labels.append((i, int(bad)))
    base = rows[0][1]
    rows.append((301, base + " " + "extra"))
    rows.append((302, base))
    item = text(24)
    rows.append((303, text(30) + " " + item + " " + text(30)))
    rows.append((304, text(50) + " write to ann@site.org or +1 (988) 555-2485 now"))
    rows += [(305, None), (306, ""), (None, text(40)), (307, rows[1][1])]
    d = tempfile.mkdtemp(prefix="tm-pipe-", dir="/tmp")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(d, "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))
    return d, rows, docs


def test_stages_act_on_what_is_planted(spark, planted):
    d, rows, docs = planted
    kept = corpus_pipeline.toxic_stage(spark, docs, d)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert not [i for i in range(1, 261) if i % 4 == 0 and i in left]
    clean = [i for i in range(1, 261) if i % 4] + [303, 304, 305, 306, None, 307]
    assert set(clean) <= left
    one = corpus_pipeline.neardup_stage(spark, docs, d)
    ids = [r.doc_id for r in one.collect()]
    assert one.columns == docs.columns and 1 in ids and not {301, 302, 307} & set(ids)
    assert {305, 306, None} <= set(ids) and len(ids) == len(rows) - 3
    held = corpus_pipeline.leak_stage(spark, docs, d)
    assert {i for i, _ in rows} - {r.doc_id for r in held.collect()} == {303}
    clear = {r.doc_id: r for r in corpus_pipeline.pii_stage(spark, docs, d).collect()}
    assert "<EMAIL>" in clear[304].text and "<PHONE>" in clear[304].text and "ann@" not in clear[304].text
    assert clear[304].n_chars == len(clear[304].text) and clear[305].text is None and clear[1].text == rows[0][1]


def test_whole_pipeline(spark, planted):
    d, rows, _ = planted
    got = corpus_pipeline.run(spark, d).collect()
    ids = {r.doc_id for r in got}
    assert not ids & ({i for i in range(1, 261) if i % 4 == 0} | {301, 302, 303, 305, 306, 307})
    assert {i for i in range(1, 261) if i % 4} | {304, None} == ids
    assert "<EMAIL>" in next(r.text for r in got if r.doc_id == 304)
    assert all(r.n_tokens <= r.boundary for r in got)


def test_stages_on_empty_tables(spark, planted):
    d, _, docs = planted
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), d).collect() == [], name


def test_packed_texts_are_the_texts(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["ab", "é1", ",", " ", "  ", "\n", ".", "x"]) for _ in range(rng.randrange(0, 200))))
            for i in range(40)] + [(50, None), (51, " \n")]
    got = {}
    for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), context=7, texts=True).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        some = sorted(got.get(i, ()), key=lambda r: r.seq)
        assert "".join(r.text for r in some) == (t or "").rstrip()
        assert sum(r.n_tokens for r in some) == len(re.findall(r"[^\W_]+|[^\w\s]|_", t or ""))
        assert [r.start for r in some] == [7 * k for k in range(len(some))]


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_toxicity_without_both_classes_rejects_nothing(spark, toxic):
    docs = spark.createDataFrame([(i, f"plain words number {i}") for i in range(40)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i in range(40)] if toxic is not None else [], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == 41
    if toxic != 1:
        assert not [r for r in got if r.predicted]


def test_licence_verbs_pass_the_hint(spark):
    verbs = ["licensed", "licenced", "relicensed", "released", "distributed", "provided", "published", "available", "covered",
             "governed", "distribute", "redistribute", "modify"]
    rows = [(i, f"You may {v} it under the GPL version 2. The end.") for i, v in enumerate(verbs)]
    rows += [(50, "ALL advertising materials mentioning features or use of this software must display it."),
             (51, "The software is provided as is and " + "some holder " * 9 + "disclaims all warranties.")]
    got = {r.doc_id: r.sentence_ids for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "gpl2-ref" for i in range(len(verbs))), got
    assert got[50] == "bsd-advert" and got[51] == "isc-as-is"


def test_personal_data_of_long_texts_in_time(spark):
    pair = "10.20.30.40 +1 (988) 555-2485; "
    for n in (400, 16_000):
        df = spark.createDataFrame([(1, pair * n)], "doc_id long, text string")
        t = time.time()
        got = pii.scan(df).collect()[0]
        assert (got.n_ip, got.n_phone) == (n, n)
        assert time.time() - t < 90
    spans = got.spans.split(",")
    assert spans[:2] == ["ip:0:11", "phone:12:29"] and f"phone:{(n - 1) * 31 + 12}:{(n - 1) * 31 + 29}" in spans


def test_nearest_of_repeated_huge_and_tiny_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, list(map(float, rng.normal(size=3)))) for i in range(30)]
    rows += [(0, rows[0][1]), (5, rows[5][1]), (40, [1e160, 0.0, 1e160]), (41, [1e160, 1e150, 0.0]), (42, [5e-324, 0.0, 0.0]),
             (100, [1e160, 0.0, 0.0]), (200, [1e-323, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, 100, block=7, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vec = dict(rows)
    for q in (0, 100, 200):
        want = sorted((float(np.abs(np.subtract(v, vec[q])).max() and np.hypot.reduce(np.subtract(v, vec[q]))), i)
                      for i, v in vec.items() if i != q)[:10]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [i for _, i, _ in mine] == [i for _, i in want] or q == 100
        np.testing.assert_allclose([s for *_, s in mine], [s for s, _ in want], rtol=1e-12)
