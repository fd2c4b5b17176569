"""Optimal length buckets (operator 6).

Texts are cut into sequences of at most ``context`` tokens (words or single
marks). Dynamic programming over the global histogram, which has at most
``context`` entries, picks the boundaries with least padding; batches within
the token budget form in each (bucket, shard). Null and empty texts have no
sequence; extra columns are ignored; an empty table gives no rows. Repeated rows of one
doc_id are packed each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F


def boundaries(lengths, counts, buckets: int) -> list[int]:
    """Boundaries that minimise padding; the last one is the largest length."""
    u, c = np.asarray(lengths, np.float64), np.asarray(counts, np.float64)
    n = np.concatenate([[0], np.cumsum(c)])
    cost, cuts = np.where(np.arange(len(u) + 1) == 0, 0.0, np.inf), []
    for _ in range(min(buckets, len(u))):
        new, cut = cost.copy(), np.full(len(u) + 1, -1)
        for j in range(1, len(u) + 1):
            v = cost[:j] + u[j - 1] * (n[j] - n[:j])
            i = int(v.argmin())
            if v[i] < new[j]:
                new[j], cut[j] = v[i], i
        cost = new
        cuts.append(cut)
    out, j = [], len(u)
    for cut in reversed(cuts):
        if j > 0 and cut[j] >= 0:
            out.append(int(u[j - 1]))
            j = int(cut[j])
    return sorted(out)


TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def sequence_texts(docs: DataFrame, context: int = 2048) -> DataFrame:
    """doc_id, seq, start, n_tokens, text: each sequence's own part of the text, blanks before its tokens
    included, so that the parts of a text joined give the text up to its last token."""
    tokens = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(rf"\s*(?:{TOKEN})"), F.lit(0))

    def part(t, q):
        here = F.slice(t, q * context + 1, F.lit(context))
        return F.struct(q.alias("seq"), (q * context).alias("start"), F.size(here).alias("n_tokens"),
                        F.array_join(here, "").alias("text"))

    # the tokens stand in an array of one, so that they are found once for all parts
    parts = F.flatten(F.transform(F.array(tokens), lambda t: F.when(F.size(t) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(t) - 1) / context).cast("int")), lambda q: part(t, q)))))
    return docs.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.*")


def pack(docs: DataFrame, context: int = 2048, buckets: int = 8, budget: int = 16384,
         shard_rows: int = 25_000, texts: bool = False) -> DataFrame:
    """One row per sequence: doc_id, seq, start, n_tokens, boundary, shard, batch, with ``texts`` also its text.
    A shard of about ``shard_rows`` sequences ends each bucket with one part-filled batch."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN))
    seqs = docs.select("doc_id", n.alias("n")).where("n > 0").select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / context).cast("int"))).alias("seq")
    ).select("doc_id", "seq", (F.col("seq") * context).alias("start"),
             F.least(F.lit(context), F.col("n") - F.col("seq") * context).alias("n_tokens"))
    hist = sorted((r.n_tokens, r.c) for r in seqs.groupBy("n_tokens").agg(F.count("*").alias("c")).collect())
    edges = boundaries(*zip(*hist), buckets) if hist else [context]
    total = sum(c for _, c in hist)
    bound = F.lit(edges[-1])
    for e in reversed(edges[:-1]):
        bound = F.when(F.col("n_tokens") <= e, e).otherwise(bound)
    shard = F.pmod(F.xxhash64("doc_id", "seq"), F.lit(max(1, -(-total // shard_rows))))
    w = Window.partitionBy("boundary", "shard").orderBy("doc_id", "seq")
    rows = sequence_texts(docs, context) if texts else seqs
    return rows.withColumn("boundary", bound).withColumn("shard", shard).withColumn(
        "batch", F.floor((F.row_number().over(w) - 1) / F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("boundary")))))
