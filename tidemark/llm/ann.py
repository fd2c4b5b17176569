"""Exact nearest neighbours by int8 product tiles (operator 4).

Vectors are dealt to query blocks and candidate blocks; each tile forms int8
products, whose quantisation error bounds rule pairs out, and recomputes the
rest in double precision. Heaps merge a tile's answers, a ranked window the
tiles'. Null, zero and non-finite vectors take no part; ties go to the
smaller vec_id; an empty table gives no rows. Rows of one vec_id are one vector, the
least in component order.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F


def _int8(x):
    s = np.maximum(np.abs(x).max(axis=1, keepdims=True) / 127, np.finfo(np.float64).tiny)
    q = np.clip(np.rint(x / s), -127, 127)
    return q.astype(np.int8), s[:, 0], np.linalg.norm(x - q * s, axis=1)


def _products(a, b):
    """Exact inner products of int8 rows: a float32 product holds them up to 2 ** 24."""
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.float64)


def distances(c, q):
    """Euclidean distances of rows ``c`` to ``q``; scaled where the squares leave the range of doubles."""
    diff = c - q
    d2 = (diff ** 2).sum(axis=1)
    d = np.sqrt(d2)
    odd = ~np.isfinite(d2) | (d2 < 1e-280)
    if odd.any():
        top = np.abs(diff[odd]).max(axis=1)
        with np.errstate(invalid="ignore"):
            part = diff[odd] / np.where(top > 0, top, 1.0)[:, None]
            d[odd] = np.where(np.isfinite(top), top * np.sqrt((part ** 2).sum(axis=1)), np.inf)
    return d


def tile(qs: pd.DataFrame, cs: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = []
    if len(qs) and len(cs):
        q, c = (np.array(p["v"].tolist(), np.float64) for p in (qs, cs))
        with np.errstate(all="ignore"):
            q8, qa, qe = _int8(q)
            c8, ca, ce = _int8(c)
            dot = _products(q8, c8) * qa[:, None] * ca
            qn, cn = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
            err = qn[:, None] * ce + (cn + ce) * qe[:, None]
            mid = qn[:, None] ** 2 + cn ** 2 - 2 * dot
            slack = 2 * err + 1e-9 * (1 + qn[:, None] ** 2 + cn ** 2)
            least, most = mid - slack, mid + slack
            # no bound where a square overflows: such pairs are always recomputed
            odd = ~np.isfinite(least) | ~np.isfinite(most)
            least[odd], most[odd] = -np.inf, np.inf
            ids = cs["id"].to_numpy()
            for i, qid in enumerate(qs["id"]):
                other = ids != qid
                hi = np.sort(most[i][other])
                if not len(hi):
                    continue
                keep = np.flatnonzero(other & (least[i] <= hi[min(k, len(hi)) - 1]))
                rows += [(qid, v, s) for s, v in heapq.nsmallest(k, zip(distances(c[keep], q[i]), ids[keep]))]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, every: int, k: int = 10,
           query_block: int = 256, block: int = 4096) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``every``."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ok = vectors.select(F.col("vec_id").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)).groupBy("id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))
    size = ok.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    nb, qb = -(-max(size[0], 1) // block), -(-max(size[1], 1) // query_block)
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cs = ok.withColumn("cb", deal(nb).cast("int")).withColumn("qb", span(qb))
    qs = ok.where(F.col("id") % every == 0).withColumn("qb", deal(qb).cast("int")).withColumn("cb", span(nb))
    found = qs.groupBy("d", "qb", "cb").cogroup(cs.groupBy("d", "qb", "cb")).applyInPandas(
        lambda a, b: tile(a, b, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
