"""Brute-force versions and edge rows of the llm operators."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (ann, decontaminate, fixity, licenses, neardup, packing, pii, secrets,
                          suffix_dedup, toxicity)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    text = "Mail a.b@c.d_e@f.g now +1 (988) 555-2485 4041894974608795 1.2.3.400 1.2.3.40 é a@b.c"
    rows = [(1, None, 0), (2, "", 0), (3, text, 1), (4, text, 1), (5, "one two", 2), (6, "x" * 5000, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def luhn(d):
    s = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
    return s % 10 == 0


def brute_pii(text):
    d = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d(m)) <= 19 and luhn(d(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(d(m)) <= 15)]
    out = sorted((m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules)
                 for m in re.finditer(p, text or "") if ok(m))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in out).encode()).hexdigest()


def test_pii_base_spans(docs, edge):
    for df in (docs, edge):
        want = {r.doc_id: brute_pii(r.text) for r in df.collect()}
        got = {r.doc_id: r.base_sha256 for r in pii.scan(df).collect()}
        assert got == want


def test_pii_redacts_base_and_chosen(spark):
    rows = [(1, "write a.b@c.org or 555-0199-22 now"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cell = [(9, 2, 3, 3)]  # digits, marks, blank before, blank after
    for chosen, want in (([], "write <EMAIL> or 555-0199-22 now"), (cell, "write <EMAIL> or <NUMBER> now")):
        got = {r.doc_id: r.t for r in df.select("doc_id", pii.redact(F.col("text"), chosen).alias("t")).collect()}
        assert got == {1: want, 2: None, 3: ""}


def test_secrets(edge, docs):
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for r in docs.collect():
        assert got[r.doc_id].n_access == len([m for m in re.findall(r"AKIA[A-Z0-9]+", r.text) if len(m) >= 18])
    assert secrets.scan(edge).count() == 6


def brute_secrets(text):
    rules = [("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
              r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)",
              lambda m: len(m[2]) >= 12),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    out = sorted((m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules)
                 for m in re.finditer(p, text or "") if ok(m))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in out).encode()).hexdigest()


def test_secret_base_spans(docs, spark):
    rows = [(1, "TOKEN = 'abcdefghijkl' pass passwd:short Api_Key=" + "a1" * 9), (2, None), (3, "ſecret=abcdefghijklmnop"),
            (4, "apikey=AKIA" + "B" * 15), (5, "")]
    for df in (docs, spark.createDataFrame(rows, "doc_id long, text string")):
        want = {r.doc_id: brute_secrets(r.text) for r in df.collect()}
        assert {r.doc_id: r.base_sha256 for r in secrets.scan(df).collect()} == want


def test_neardup_components(docs, edge):
    rows = docs.collect()
    sets = {}
    for r in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    comp = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {d: lo if c == hi else c for d, c in comp.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(docs, 3, 85, 100).collect()}
    assert got == {d: (len(sets[d]), comp[d]) for d in ids}
    kept = {r.doc_id: r.kept for r in neardup.groups(edge, 3, 85, 100).collect()}
    assert kept == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True}


def brute_components(rows, words, num, den):
    sets = {}
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if den * min(len(x), len(y)) >= num * max(len(x), len(y)) and find(a) != find(b):
                if den * len(x & y) >= num * len(x | y):
                    lo, hi = sorted((find(a), find(b)))
                    comp[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_neardup_large_families(spark, monkeypatch):
    """Edited copies at every distance, cut copies, chains and exact copies, in small blocks and stars."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    rows = []

    def edited(w, k):
        w = list(w)
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        return w

    for f in range(4):
        base = [rng.choice(vocab) for _ in range(90)]
        rows += [(None, " ".join(edited(base, rng.randrange(0, 9)))) for _ in range(70)]
        rows += [(None, " ".join(base[:rng.randrange(60, 91)])) for _ in range(30)]
        chain = base
        for _ in range(25):
            chain = edited(chain, 2)
            rows.append((None, " ".join(chain)))
        rows += [(None, " ".join(base))] * 5
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want = brute_components(rows, 3, 85, 100)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, label string, id int")
    monkeypatch.setattr(neardup, "STAR", 20)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(df, 3, 85, 100).collect()}
    assert got == want


def test_neardup_odd_rows(spark):
    a = " ".join(f"t{i}" for i in range(60))
    rows = [(1, a), (1, a + " more"), (1, None), (2, a), (3, a + " end"), (None, "q r s"), (4, ""), (5, None), (6, "one"), (7, "One")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, keys int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df, 3, 85, 100).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, None}
    assert got[6] == (1, 6, True) and got[7] == (1, 6, False)
    assert got[4] == (0, 4, True) and got[5] == (0, 5, True)
    assert got[3][1] == got[2][1]
    assert neardup.groups(df.limit(0), 3, 85, 100).collect() == []


def test_ann_is_exact(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = emb.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in ann.search(emb, 100).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[ids == q]) ** 2).sum(axis=1))
        near = [i for _, i in sorted(zip(d, ids)) if i != q][:10]
        assert [got[q][k] for k in range(1, 11)] == near


def test_ann_skips_bad_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, 0.0]), (5, [2.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 100).collect()
    assert [(r.vec_id, r.score) for r in got] == [(4, 0.0), (5, 1.0)]


def check_suffix_dedup(spark, texts, **options):
    seen = {}
    for t in texts.values():
        t = (t or "").encode()
        for i in range(len(t) - 399):
            seen[t[i:i + 400]] = seen.get(t[i:i + 400], 0) + 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.dedup(df, **options).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        t = (t or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        kept = hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), sum(gone), spans, kept), d


def test_suffix_dedup(spark, docs, edge):
    rows = docs.limit(60).collect() + edge.collect()
    check_suffix_dedup(spark, {i: r.text for i, r in enumerate(rows)})


def test_suffix_dedup_short_periods_and_empty(spark):
    noise = "".join(chr(97 + x) for x in np.random.default_rng(1).integers(0, 26, 3000))
    texts = ["a" * 500, noise[:900] + "xyz" * 700 + noise[900:1500], "xyz" * 200, "b" * 399, None, "",
             noise[100:700], (noise[2000:2377] * 5), "é" * 450]
    check_suffix_dedup(spark, dict(enumerate(texts)))
    empty = spark.createDataFrame([], "doc_id long, text string, key string, h int")
    assert suffix_dedup.dedup(empty).collect() == []


def test_suffix_dedup_divides_crowded_anchors(spark):
    rng = np.random.default_rng(2)
    noise = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    line, passage, block = noise(150), noise(390), noise(430)
    texts = [noise(300) + line + noise(300) for _ in range(25)] + [noise(200) + passage + noise(200) for _ in range(25)]
    texts += [noise(200) + block + noise(200) for _ in range(12)] + [noise(3) + passage + "q" * (i % 8) + noise(90) for i in range(12)]
    tail = noise(260)
    texts += [noise(50) + line + tail + noise(40) for _ in range(10)] + [tail + line + noise(100)] * 2 + ["z" * 1500, "z" * 450]
    check_suffix_dedup(spark, dict(enumerate(texts)), split=4)
    check_suffix_dedup(spark, dict(enumerate(texts)))


def test_common_prefixes():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        x = np.append(rng.integers(0, 2, n), -1)
        x = np.concatenate([x, x[:-1], [-2]])
        sa = suffix_dedup.suffix_array(x)
        order = np.where(x < 0, -1000 - x, x)  # ends sort before bytes, earlier ones first
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: order[i:].tolist())
        before, length = suffix_dedup.common_prefixes(x, sa)
        for a, b in zip(sa[:-1], sa[1:]):
            both = list(zip(x[a:].tolist(), x[b:].tolist()))
            want = next(i for i, (p, q) in enumerate(both) if p != q)
            assert (before[b], length[b]) == (a, want)
        assert before[sa[0]] == -1 and length[sa[0]] == 0


def test_packing_boundaries_are_optimal():
    u, c = [1, 2, 5, 9], [5, 1, 7, 2]
    pad = lambda bs: sum(n * (min(b for b in bs if b >= x) - x) for x, n in zip(u, c))
    best = min(pad([a, b, 9]) for a in u[:3] for b in u[:3])
    assert pad(packing.boundaries(u, c, 3)) == best
    assert packing.boundaries([4], [3], 8) == [4]


def test_packing_covers_all_tokens(docs, edge):
    got = packing.pack(docs, context=256).collect()
    assert all(r.n_tokens <= r.boundary for r in got)
    assert {r.doc_id for r in packing.pack(edge).collect()} == {3, 4, 5, 6}


def test_fixity_finds_damage(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    a = fixity.records(pages, 3)
    found = lambda b: sorted((r.page_id, r.status, r.copies) for r in fixity.audit(a, fixity.records(b, 3)).collect())
    assert found(pages) == []
    assert found(pages.selectExpr("page_id", "url", "if(page_id = 3, 'x', html) html")) == [(3, "corrupt", 1)]
    assert found(pages.where("page_id <> 5")) == [(5, "missing", 1)]
    assert found(pages.union(pages.selectExpr("-1L", "url", "html").limit(1))) == [(-1, "extra", 1)]
    assert len(found(pages.limit(0))) == pages.count()


def test_fixity_edge_rows(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 3), (1, "u", "other", 4), (2, None, "é" * 9000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, leaf int")
    a = fixity.records(pages, 2)
    assert {(r.page_id, r.copies) for r in a.collect()} == {(None, 1), (1, 2), (1, 1), (2, 1)}
    for r in a.collect():
        assert r.offset == sum(x.length * x.copies for x in a.collect() if x.file == r.file and (
            x.pos, x.page_id, x.url, x.leaf) < (r.pos, r.page_id, r.url, r.leaf))
    assert fixity.audit(a, a).count() == 0
    got = fixity.audit(a, fixity.records(pages.where("leaf not in (1, 3)"), 2)).collect()
    assert sorted((str(r.page_id), r.status, r.copies) for r in got) == [("1", "missing", 1), ("None", "missing", 1)]


def test_licenses(spark):
    df = spark.createDataFrame([(1, "Hi. Released under the MIT License. Bye"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in licenses.scan(df).collect()} == {1: "MIT", 2: ""}


def test_template_matches_changed_numbers(spark):
    q = "a train leaves at {} and travels for {} hours towards the far old city"
    df = spark.createDataFrame([(1, q.format(7, 9)), (2, "nothing of the kind is here at all today my friend"), (3, None)],
                               "doc_id long, text string")
    bench = spark.createDataFrame([(1, q.format(3, 5))], "item_id long, text string")
    assert [(r.doc_id, r.exact_slots) for r in decontaminate.contamination(df, bench).collect()] == [(1, False)]


def test_bit_table_loses_no_match(docs, spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    narrow, wide = (sorted((r.doc_id, r.item_id, r.matched) for r in
                           decontaminate.contamination(docs, bench, bits=n).collect()) for n in (64, 1 << 20))
    texts = {r.item_id: r.text for r in bench.collect()}
    held = {(d.doc_id, i) for d in docs.collect() for i, t in texts.items() if t in (d.text or "")}
    assert narrow == wide and held <= {x[:2] for x in wide}


def test_decontamination_edge_rows(edge, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge, none).count() == 0
    bench = spark.createDataFrame([(7, "one two"), (8, None), (9, "")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contamination(edge, bench).collect()] == [(5, 7)]
    lost = spark.createDataFrame([(None, "one two")], "doc_id long, text string")
    assert decontaminate.contamination(lost, bench).count() == 0


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = toxicity.score(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    rows = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.9


def test_toxicity_german_french_recall(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.score(docs, labels).where("held_out").join(labels, "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").where("toxic is not null").collect()
    for lang, least in (("en", 0.9), ("de", 0.8), ("fr", 0.8), ("es", 0.6)):
        bad = [r.predicted for r in rows if r.lang == lang and r.toxic == 1]
        assert sum(bad) >= least * len(bad)
    fine = [r.predicted for r in rows if r.toxic == 0]
    assert sum(fine) <= 0.02 * len(fine)


def brute_toxicity(rows):
    """Log ratio a word of each expression, by the formulas of the models over plain dictionaries."""
    n, info = [Counter(), Counter()], {}
    for text, y in rows:
        words = re.findall(r"[^\W\d_]+|\d+", (text or "").lower())
        for w in set(words):
            s = "^^" + w + "$"
            n[y]["root"] += 1
            for k in range(3, len(s) + 1):
                up = s[:k - 1] if k > 3 else "root"
                n[y][s[:k]] += 1
                info[s[:k]] = (up, up, s[k - 3:k], s[k - 3:k - 1], 1)
        for g in set(zip(words, words[1:])):
            up = "^^" + g[0] + "$"
            n[y][g] += 1
            n[y]["after", up] += 1
            info[g] = (up, ("after", up), ("word", g[1]), "any", 2)
    info = {h: r for h, r in info.items() if n[1][h] > toxicity.D}
    tails, ctxs = Counter(r[2] for r in info.values()), Counter(r[3] for r in info.values())

    def step(h):
        _, ctx, tail, tctx, _ = info[h]
        q, out = tails[tail] / (ctxs[tctx] + 1), []
        for c in n:
            after = [c[g] for g, r in info.items() if r[1] == ctx]
            kinds = sum(x > 0 for x in after) + (c[ctx] > sum(after))
            out.append(np.log((max(c[h] - toxicity.D, 0) + (toxicity.THETA + toxicity.D * kinds) * q)
                              / (c[ctx] + toxicity.THETA)))
        return out[1] - out[0]

    def total(h):
        return 0.0 if h == "root" else step(h) + total(info[h][0])

    out = {h: total(h) / info[h][4] for h in info}
    return {h: v for h, v in out.items() if v >= toxicity.FLOOR and v > out.get(info[h][0], v - 1)}


def test_toxicity_models_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choice(("ab", "abc", "ba", "éa", "c\U0001F600c", "7", "abba")) for _ in range(12))
             + (rng.choice((" you rot ab", " vile bog ba", " you abc")) if y else " you abc"), y) for y in [0, 1] * 40]
    rows += [(None, 1), ("", 0), ("... !", 1)]
    want = brute_toxicity(rows)
    assert len(want) > 5
    df = spark.createDataFrame(rows, "text string, y int")
    assert sorted(round(r.llr, 9) for r in toxicity.train(df).collect()) == sorted(
        round(v, 9) for v in want.values())
    texts = ["rotten", "you rot ab", "abc ba", "", "you", "rot", "a vile bog"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: round(r.stat, 9) for r in toxicity.statistics(docs, toxicity.train(df)).collect()}
    best = {}
    for i, text in enumerate(texts):
        words = text.split()
        names = {("^^" + w + "$")[:k] for w in words for k in range(3, len(w) + 4)}
        names |= set(zip(words, words[1:]))
        found = [want[g] for g in names if g in want]
        if found:
            best[i] = round(max(found), 9)
    assert got == best and 6 in got and 2 not in got


def brute_letters(rows):
    """Log ratio of a word under the letter models of both classes, by plain dictionaries over all their letters."""
    n, d, theta = [Counter(), Counter()], toxicity.DELTA, toxicity.THETA
    for text, y in rows:
        for w in set(re.findall(r"[^\W\d_]+|\d+", (text or "").lower())):
            n[y].update("^^" + w[:k] for k in range(1, len(w) + 1))
            n[y]["^^" + w + "$"] += 1
    types = set(n[0]) | set(n[1])
    two = Counter(h[-3:] for h in types)
    one = Counter(t[1:] for t in two)
    none = Counter(t[1:] for t in one)

    def share(counts, key, lower):
        same = [v for k, v in counts.items() if k[:-1] == key[:-1]]
        return (max(counts[key] - d, 0) + d * len(same) * lower) / sum(same)

    def ratio(word):
        out = 0.0
        for k in range(1, len(word) + 2):
            h = ("^^" + word + "$")[:k + 2]
            p, after = [], [t for t in types if t[:-1] == h[:-1]]
            if not after:
                break
            # a letter never seen after this beginning: the backoff cancels
            q = share(two, h[-3:], share(one, h[-2:], share(none, h[-1:], 1 / (len(none) + 1)))) if h in types else 1.0
            for c in n:
                left = sum(min(c[t], toxicity.D) for t in after)
                p.append((max(c[h] - toxicity.D, 0) + (theta + left) * q) / (sum(c[t] for t in after) + theta))
            out += np.log(p[1]) - np.log(p[0])
        return out

    return ratio


def test_toxicity_compares_whole_texts(spark, monkeypatch):
    """Each word of a text counts, also those of ordinary texts alone or never seen; the same if the tasks hold few rows."""
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(("calm", "cab", "dabé", "day", "7", "\U00010400a")) for _ in range(6))
             + (rng.choice((" rotten", " rot", " vile")) if y else " fine") + f" u{rng.choice('abcdefgh')}", y) for y in [0, 1, 0] * 12]
    rows += [(None, 1), ("", 0)]
    labelled = spark.createDataFrame(rows, "text string, y int")
    ratio = brute_letters(rows)
    texts = ["calm day calm fine", "rotten vile rots cat", "zzz", "fin dabé ua 77", None, "... !"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    letters, model = toxicity.letter_weights(labelled), toxicity.train(labelled, recursive=True, longest=3, floor=0.0)
    tops = []
    for table in (toxicity.TABLE, 12):
        monkeypatch.setattr(toxicity, "TABLE", table)
        got = {r.doc_id: r for r in toxicity.measures(docs, model, letters, longest=3).collect()}
        for i, text in enumerate(texts):
            words = re.findall(r"[^\W\d_]+|\d+", text or "")
            assert got[i].words == len(words) and got[i].rows == 1
            assert not words and got[i]["mean"] is None or abs(
                got[i]["mean"] - sum(map(ratio, words)) / len(words)) < 1e-5
        tops.append({i: r.top for i, r in got.items()})
    assert got[0]["mean"] < 0 < got[1]["mean"] and tops[0] == tops[1] and tops[0][1] > 0


def test_toxicity_reads_phrases_of_three_words_and_rows_without_key(spark):
    """``go home now`` is toxic, each word and pair of it is not; a text without doc_id is scored too."""
    bad = ["go home now", "we go home and home now"]
    rows = [(" ".join(["so", bad[0] if y else bad[1], str(i)]), y) for i in range(30) for y in (0, 1)]
    df = spark.createDataFrame(rows, "text string, y int")
    docs = spark.createDataFrame([(1, bad[0]), (2, bad[1])], "doc_id long, text string")
    two, three = ({r.doc_id: r.top for r in toxicity.measures(docs, toxicity.train(
        df, recursive=True, longest=n, floor=0.0), longest=n).collect()} for n in (2, 3))
    assert three[1] > max(two[1], three[2])
    texts = ["you rotten vile bog" if i % 3 == 0 else "a fine calm day" for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (None, texts[1]), (None, texts[0])], "doc_id long, text string")
    got = [r for r in toxicity.score(docs, labels).collect()]
    assert len(got) == 63 and sorted(r.predicted for r in got if r.doc_id is None) == [0, 1, 1]
    assert not any(r.held_out for r in got if r.doc_id is None)


def test_licenses_of_real_texts(spark):
    mit = ("MIT License\n\nCopyright (c) 2020 A. B.\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software.\n\n"
           "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING.")
    bsd = ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that:\n"
           "# 1. Redistributions of source code must retain the above.\n")
    rows = [
        (mit, "MIT"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file", "Apache-2.0"),
        (bsd, "BSD-2-Clause"),
        (bsd + "# Neither the name of X nor the names of its contributors may be used to endorse or\n"
         "# promote products derived from this software without specific prior written permission.", "BSD-3-Clause"),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
         "granted.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES", "ISC"),
        ("you can redistribute it and/or modify it. Distributed under the terms of the GNU Lesser General\n"
         "Public License as published by the Free Software Foundation; either version 2.1 of the\n"
         "License, or (at your option) any later version.", "LGPL-2.1-or-later"),
        ("Released under the GNU General Public License version 2", "GPL-2.0"),
        ("licensed under the GNU Affero General Public License v3.0", "AGPL-3.0"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "MPL-2.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) */", "Apache-2.0,MIT"),
        ("this is not released under the MIT license", ""),
        ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
        ("it is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
         "as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
         "GPL-3.0-or-later"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(rows)}


def test_decontamination_judges_each_occurrence(spark):
    item = "a box holds 5 red balls and 5 blue balls so how many balls are in it"
    other = item.replace("5 red", "8 red").replace("5 blue", "9 blue")
    third = item.replace("5 red", "2 red").replace("5 blue", "3 blue")
    gap = " then we talked for a long time about the weather and went home again "
    rows = [(1, item + gap + other), (2, other + gap + third), (3, other), (4, gap)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id: r.exact_slots for r in got} == {1: True, 2: False, 3: False}


def test_decontamination_finds_short_items_in_long_documents(spark):
    talk = "we talked for a long time about many things and then somebody asked "
    rows = [(1, talk + "What is entropy exactly and left"), (2, talk + "how many is 7 plus 9 and left"),
            (3, talk + "how many is 7 plus 8 and left"), (4, talk), (5, "how many is 1 plus 2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "What is entropy"), (2, "how many is 7 plus 9")], "item_id long, text string")
    got = decontaminate.contamination(df, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 2), (5, 2)]


def test_neardup_links_of_far_stars(spark):
    """Two texts that share a star are compared however little they have of its centre, and in each
    star that they share, not in the nearest one only."""
    w = [f"v{i}" for i in range(200)]
    texts = {1: w[:40] + w[100:160], 2: w[:100], 3: w[:98] + ["end", "off"], 4: w[5:100], 5: w[4:104]}
    sets = {i: set(zip(t, t[1:])) for i, t in texts.items()}

    def star(a, i):
        return a, i, len(sets[a]), len(sets[i]), len(sets[a] & sets[i])

    def found(stars, labels):
        rows = spark.createDataFrame(stars, "a long, id long, n_a long, n long, both long")
        lab = spark.createDataFrame(labels, "id long, label long")
        body = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "id long, text string")
        return {tuple(sorted(r)) for r in neardup.rest_links(rows, lab, body, 2, 85, 100).collect()}

    assert found([star(1, 2), star(1, 3)], []) == {(2, 3)}
    # 2 is nearer to 4, whose star 3 is not in; in the star of 5, 3 is of the centre's component
    assert found([star(4, 2), star(4, 1), star(5, 2), star(5, 3)], [(5, 3), (3, 3)]) == {(2, 3)}


def test_toxicity_backoff_is_recursive(spark):
    """Shares of each order from plain dictionaries; with all unseen mass they add up to less than one."""
    rng = random.Random(8)
    seen = Counter({(rng.choice("abcde"), rng.choice("abc"), rng.choice("^ab")): rng.randrange(1, 9) for _ in range(40)})
    after = Counter(rng.choice(range(100, 120)) for _ in range(60))
    d = toxicity.DELTA

    def share(counts, x, lower):
        return (max(counts[x] - d, 0) + d * len(counts) * lower) / sum(counts.values())

    def q(x, p1, p2):
        ones = Counter((y, p) for y, p, _ in seen)
        nones = Counter(y for y, _ in ones)
        q0 = share(nones, x, 1 / (len(nones) + 1))
        q1 = share(Counter({y: n for (y, p), n in ones.items() if p == p1}), x, q0)
        return share(Counter({y: n for (y, a, b), n in seen.items() if (a, b) == (p1, p2)}), x, q1)

    want = {((ord(x) << 42) | (ord(a) << 21) | ord(b), (ord(a) << 21) | ord(b)): q(x, a, b) for x, a, b in seen}
    want |= {(w, toxicity.ANY): share(after, w, 1 / (len(after) + 1)) for w in after}
    rows = [((ord(x) << 42) | (ord(a) << 21) | ord(b), (ord(a) << 21) | ord(b), n) for (x, a, b), n in seen.items()]
    rows += [(w, toxicity.ANY, n) for w, n in after.items()]
    got = {(r.tail, r.tctx): r.q for r in toxicity.continuation(
        spark.createDataFrame(rows, "tail long, tctx long, k long")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    texts = [("you rotten bog", 1), ("vile rot you", 1), ("you abc fine", 0), ("fine day abc", 0)] * 5
    df = spark.createDataFrame(texts, "text string, y int")
    plain, deep = ({r.h: r.llr for r in toxicity.train(df, recursive=x).collect()} for x in (False, True))
    assert deep and deep != plain


def test_bit_table_reaches_the_driver_in_few_rows(spark, monkeypatch):
    hashes = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    h = np.array([r.h for r in hashes.collect()], np.int64).view(np.uint64)
    kind, received = type(hashes), []
    for name in ("collect", "toPandas"):
        def counted(df, plain=getattr(kind, name)):
            received.append(rows := plain(df))
            return rows
        monkeypatch.setattr(kind, name, counted)
    for size in (64, 1 << 12, 1 << 22):
        received.clear()
        at = h & np.uint64(size - 1)
        want = np.zeros(size // 64, np.uint64)
        np.bitwise_or.at(want, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        assert (decontaminate.bit_table(hashes, size) == want).all()
        assert sum(map(len, received)) <= 8  # 2**16 words at most, 2**13 a row
    assert not decontaminate.bit_table(hashes.limit(0), 128).any()


def test_neardup_rest_does_not_deal_members_to_many_blocks(spark, monkeypatch):
    """Members far from their centre and from each other are read about once; kin among them still link."""
    rng = random.Random(11)
    centre = [f"c{i}" for i in range(60)]
    texts = {0: centre}
    for i in range(1, 401):
        if i % 20 == 0:
            w = [*texts[i - 1]]
            w[rng.randrange(60)] = f"kin{i}"
        elif i % 20 == 10:
            w = centre[:rng.randrange(35, 46)]
        else:
            w = [*centre]
            for k in rng.sample(range(60), rng.randrange(8, 16)):
                w[k] = f"e{rng.randrange(300)}"
        texts[i] = w
    sets = {i: set(zip(t, t[1:])) for i, t in texts.items()}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    own = [j for i, j in links if i == 0]
    comp = {i: 0 if i in own else i for i in sets}
    want = {(i, j) for i, j in links if i and comp[i] != comp[j]}
    assert len(want) >= 15
    read = []
    for name in ("compared", "compared_blocks"):
        if plain := getattr(neardup, name, None):
            def counted(rows, *args, plain=plain):
                read.append(rows.count())
                return plain(rows, *args)
            monkeypatch.setattr(neardup, name, counted)
    stars = spark.createDataFrame([(0, i, len(sets[0]), len(s), len(sets[0] & s)) for i, s in sets.items() if i],
                                  "a long, id long, n_a long, n long, both long")
    labels = spark.createDataFrame([(0, 0)] + [(i, 0) for i in own], "id long, label long")
    body = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "id long, text string")
    got = {tuple(sorted(r)) for r in neardup.rest_links(stars, labels, body, 2, 80, 100).collect()}
    assert got == want
    assert sum(read) <= 2 * len(texts)


def test_toxicity_small_tables_take_few_tasks(spark):
    """Each task that deals out rows leaves files: those of small tables must not grow with the shuffle partitions."""
    docs = [(i, "you rotten vile bog" if i % 3 == 0 else "a fine calm day") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    docs, tasks, want = spark.createDataFrame(docs, "doc_id long, text string"), {}, None
    held = {"spark.sql.shuffle.partitions": None, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for n in (8, 64):
            for k, v in held.items():
                spark.conf.set(k, v or str(n))
            sc.setJobGroup(f"toxicity-{n}", "")
            got = sorted((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in toxicity.score(docs, labels).collect())
            assert want in (None, got) and all(r[3] == (r[0] % 3 == 0) for r in got)
            want, tracker = got, sc.statusTracker()
            stages = {s for j in tracker.getJobIdsForGroup(f"toxicity-{n}") for s in tracker.getJobInfo(j).stageIds}
            tasks[n] = sum(x.numCompletedTasks for s in stages if (x := tracker.getStageInfo(s)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(k, None)
    assert tasks[64] < 4 * tasks[8]
