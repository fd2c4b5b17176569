"""Secret scan (operator 3): pattern spans plus character Markov models.

Two first-order character models, one of random strings (values the patterns
found) and one of ordinary identifiers (other long tokens), are counted over
all documents; a token whose mean log-likelihood ratio exceeds ``threshold``
becomes an added ``markov`` span. Nulls are empty texts; empty and long texts
and repeated rows need no special case; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SIZE = 128
KINDS = ("assign", "access", "hex", "markov")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the pattern spans, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _labelled(text: str):
    """(token, 1 random / 0 ordinary) samples of one text."""
    spans = base_spans(text)
    for m in TOKEN.finditer(text):
        yield m[0], int(any(s < m.end() and m.start() < e for s, _, e in spans))


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood-ratio matrix from transition counts of every text; the
    driver receives at most 2 x 128 x 128 sums."""
    def count(batches):
        total = np.zeros((2, SIZE, SIZE), np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                for tok, y in _labelled(text or ""):
                    b = np.frombuffer(tok.encode(), np.uint8)
                    np.add.at(total[y], (b[:-1], b[1:]), 1)
        y, a, b = np.nonzero(total)
        yield pd.DataFrame({"y": y, "a": a, "b": b, "n": total[y, a, b]})

    rows = (docs.select("text").mapInPandas(count, "y long, a long, b long, n long")
            .groupBy("y", "a", "b").agg(F.sum("n").alias("n")).collect())
    n = np.full((2, SIZE, SIZE), 0.1)
    for r in rows:
        n[r.y, r.a, r.b] += r.n
    logp = np.log(n / n.sum(axis=2, keepdims=True))
    return logp[1] - logp[0]


def scan(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document with counts and spans (code points, end exclusive)."""
    llr = train(docs)

    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                text = text or ""
                base = base_spans(text)
                more = []
                for m in TOKEN.finditer(text):
                    if any(s < m.end() and m.start() < e for s, _, e in base):
                        continue
                    b = np.frombuffer(m[0].encode(), np.uint8)
                    if llr[b[:-1], b[1:]].mean() > threshold:
                        more.append((m.start(), 3, m.end()))
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *n, hashlib.sha256(_join(base).encode()).hexdigest(),
                             _join(sorted(base + more))))
            yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex",
                                              "base_sha256", "spans"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
