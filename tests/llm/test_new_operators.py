"""Token counts, lexical search and periodic runs against libraries and brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import periodic, search, tokens

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(BPE)


def odd_rows():
    rng = random.Random(5)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß日本") for _ in range(30000))
    texts = [None, "", " ", "\n\n  x\t\ty  ", "<|endoftext|>a <|endoftext|>", "a<|endoftext|", "don't WE'LL 'Tis 1234567 ½²",
             letters, "a" * 9001, "ab" * 5000, "same", "same", "\x1c\x1d\x85  x​﻿", "é́" * 40,
             "x " * 3000, "".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x2FFFF)]))
                                  for _ in range(20000))]
    return [(i if i != 3 else None, t, "z") for i, t in enumerate(texts)]


def library(bpe, text):
    return len(bpe.encode(text or "", add_special_tokens=False).ids)


def test_tokens_as_the_library(spark, docs, bpe):
    odd = spark.createDataFrame(odd_rows(), "doc_id long, text string, n_tokens string")
    for df in (docs.select("doc_id", "text"), odd):
        want = sorted((str(r.doc_id), len((r.text or "").encode()), library(bpe, r.text)) for r in df.collect())
        got = tokens.count_tokens(df, BPE).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_tokens_all_code_points(bpe):
    m = tokens.Merges(BPE)
    import regex

    for low in range(0, 0x30000, 4096):
        text = "".join(f"a{chr(c)} {chr(c)}{chr(c)}1" for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000)
        pieces = [p.encode() for p in regex.findall(tokens.SPLIT, text)]
        if pieces:
            assert tokens.count_ragged(m, pieces).sum() == library(bpe, text), hex(low)


def test_tokens_long_and_ragged_agree():
    m = tokens.Merges(BPE)
    rng = random.Random(1)
    pieces = ["".join(rng.choice(al) for _ in range(rng.randrange(1, 400))).encode()
              for al in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", "the ination") for _ in range(60)]
    assert tokens.count_ragged(m, pieces).tolist() == [tokens.count_long(m, p) for p in pieces]


def test_tokens_small_slices_and_cache(spark, docs, bpe, monkeypatch):
    want = {r.doc_id: library(bpe, r.text) for r in docs.collect()}
    # the limits are read in the tasks; count in this process instead
    monkeypatch.setattr(tokens, "SLICE", 50)
    monkeypatch.setattr(tokens, "CACHE", 20)
    pattern = __import__("regex").compile(tokens.SPLIT)
    m = tokens.Merges(BPE)
    for r in docs.limit(20).collect():
        parts = [p for some in tokens.slices([r.text], pattern) for p in some]
        assert tokens.count_ragged(m, [p.encode() for p in parts]).sum() == want[r.doc_id]


def test_tokens_empty_table(spark):
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string"), BPE).collect() == []


def oracle(docs, items):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", items.toPandas())
    return sorted(con.execute(search.ORACLE).fetchall())


def ranking(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_against_sql(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = oracle(docs.select("doc_id", "text"), items)
    assert ranking(search.rank_items(docs, items)) == want
    # several item batches, and documents dealt over many partitions
    monkeypatch.setattr(search, "BATCH_BYTES", 2500)
    assert ranking(search.rank_items(docs.repartition(7), items)) == want


def test_search_narrow_sketches_stay_exact(docs, spark):
    """Sketches with many collisions and blocks of a few rows give the same lists."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = oracle(docs.select("doc_id", "text"), items)
    for width, rows in ((8, 37), (1, 5000), (64, 3)):
        assert ranking(search.rank_items(docs, items, width=width, rows=rows)) == want


def test_search_edge_rows(spark):
    rows = [(5, "Alpha beta, beta!"), (3, "alpha BETA beta"), (9, None), (None, "alpha alpha"), (4, ""), (7, "x" * 90000),
            (3, "alpha BETA beta"), (8, "ÄB äb alpha-beta"), (2, "!!! ???")] + [(100 + i, "gamma delta") for i in range(40)]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, score int")
    items = spark.createDataFrame([(1, "alpha beta beta"), (2, None), (3, "nothing here"), (4, "GAMMA"), (4, "GAMMA"),
                                   (6, "Äb")], "item_id long, text string")
    got = ranking(search.rank_items(docs, items))
    plain = [r for r in got if r[0] == 4]
    assert [r[2] for r in plain] == list(range(100, 110)) and len({r[3] for r in plain}) == 1
    first = [r for r in got if r[0] == 1]
    assert [r[2] for r in first] == [3, 3, 5, 8] and [r[1] for r in first] == [1, 2, 3, 4]
    assert [r[2] for r in got if r[0] == 6] == [8]
    assert not [r for r in got if r[0] in (2, 3)]
    none = spark.createDataFrame([], docs.schema)
    assert ranking(search.rank_items(none, items)) == []
    assert ranking(search.rank_items(docs, spark.createDataFrame([], items.schema))) == []
    assert ranking(search.rank_items(docs.where("doc_id = 9"), items)) == []


def brute_runs(words):
    """All stretches by direct comparison at every lag, smallest period kept."""
    n, seen = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                seen.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def brute_row(words):
    runs = brute_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *(top + (1000 * top[1] // top[2],) if top else (None,) * 4),
            hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def brute_splice(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def found(texts):
    number = {}
    lens = np.array([len(t) for t in texts])
    first = np.cumsum(lens + 1) - lens - 1
    a = np.concatenate([[number.setdefault(w, len(number)) for w in t] + [-1 - i] for i, t in enumerate(texts)])
    runs = periodic.find_runs(a, first, lens)
    out = [[] for _ in texts]
    for s, e, q in zip(runs.start.tolist(), runs.end.tolist(), runs.period.tolist()):
        i = int(np.searchsorted(first, s, "right")) - 1
        out[i].append((s - int(first[i]), e - s, q))
    return [sorted(r) for r in out]


def hard_texts():
    rng = random.Random(11)
    texts = []
    for n in (0, 1, 11, 12, 13, 30, 129, 300, 700, 1200):
        for sigma in (1, 2, 3, 50):
            texts.append([rng.randrange(sigma) for _ in range(n)])
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 1200:
        fib.append(fib[-1] + fib[-2])
    texts.append(fib[-1])
    texts.append([bin(i).count("1") % 2 for i in range(1024)])
    for _ in range(60):
        # nested powers: words of words, cut and shifted, with a few odd words between
        w = [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(1, 4)):
            w = w * rng.randrange(1, 7) + w[:rng.randrange(len(w) + 1)] + [rng.randrange(40)] * rng.randrange(2)
            w = w[:1500]
        texts.append(w[rng.randrange(len(w) // 4 + 1):])
    for p, size in ((1, 300), (2, 301), (3, 200), (8, 400), (9, 500)):
        # u u with u of a small period that does not divide it: adjoining runs of one period
        root = list(range(p))
        for off in (0, 1, p // 2):
            u = (root * size)[off:off + size]
            texts += [u + u, [99] + u + u[::1] + [98], u + u + u[:size // 2], u + [97] + u + [97] + u]
    return [[str(x) for x in t] for t in texts]


def test_runs_all_hard_texts():
    texts = hard_texts()
    assert found(texts) == [brute_runs(t) for t in texts]


def test_runs_random_structures():
    rng = random.Random(3)
    for _ in range(25):
        texts = []
        for _ in range(12):
            w = []
            while len(w) < 600:
                piece = [rng.randrange(4) for _ in range(rng.randrange(1, 90))]
                w += piece * rng.choice([1, 1, 2, 3, 9])
                if w and rng.random() < 0.3:
                    w += w[-rng.randrange(1, len(w) + 1):]
            texts.append([str(x) for x in w[:900]])
        assert found(texts) == [brute_runs(t) for t in texts]


def test_runs_query(spark, docs):
    want = {r.doc_id: brute_row(brute_splice(r.doc_id, (r.text or "").split()))
            for r in docs.collect() if len((r.text or "").split()) < 2500}
    got = {r.doc_id: tuple(r)[1:] for r in periodic.scan(docs, periodic.spliced).collect()}
    assert len(got) == docs.count()
    assert {k: got[k] for k in want} == want


def test_runs_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b " * 12), (4, "a\u00a0b " * 12), (None, "x " * 12), (5, " one\ttwo\x0bthree "), (5, "x " * 12),
            (5, "x " * 12)]
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, start int")
    got = periodic.scan(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[3][0].collapsed_sha256 == hashlib.sha256("a b".encode()).hexdigest()
    assert [(r.n_runs, r.period) for r in by[1] + by[2] + by[3] + by[4] + by[None]] == [
        (0, None), (0, None), (1, 2), (1, 1), (1, 1)]
    assert sorted(r.n_runs for r in by[5]) == [0, 1, 1]
    assert periodic.scan(spark.createDataFrame([], df.schema)).collect() == []


def test_runs_of_one_word_stay_cheap():
    long = (["w"] * 300_000 + ["v"]) * 2
    a = [str(i % 7) for i in range(200_000)]
    got = found([long, a])
    assert got[1] == [(0, 200_000, 7)]
    assert got[0] == [(0, 300_000, 1), (0, 600_002, 300_001), (300_001, 300_000, 1)]
