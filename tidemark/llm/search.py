"""Ranked lexical search with hashed max-sketches (operator 12).

Items are taken in batches of bounded text (``BATCH_BYTES``), so the vocabulary that
goes to the tasks is bounded whatever the benchmark's size. For a batch:

1. every document becomes a forward list (number of terms, ids and counts of the terms
   that the batch knows), written once to the shared folder;
2. document count, total length and document frequencies are aggregated from it;
3. each task folds the impacts ``w * tf part`` of a block of documents into sketches of
   ``width`` hashed coordinates, keeping the largest of each coordinate. One product with
   the items' term counts by coordinate gives upper bounds of all scores; documents are
   rescored exactly from their forward lists by descending bound until the next bound
   cannot enter the item's best ``k``. The best lists are kept over the task's blocks and
   merged by two window steps, the first salted.

A document's score and the ranks are exact: bounds only save rescoring. Rows are
documents each, also with a repeated doc_id; a null text has no terms; rows without
doc_id count in the statistics but cannot be ranked; items are distinct (item_id, text)
rows, one without known terms gives no rows; empty tables give no rows. Other columns are
not read.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import ensure_checkpoint_dir

# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ on UTF-8 bytes: all else is a blank
BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in BLANKED)

BATCH_BYTES = 2_000_000
BLOCK = 4096
WIDTH = 1024
COLUMNS = 512
SALTS = 64


def terms(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TABLE).split()


def spilled(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def item_batches(items: DataFrame):
    """Lists of (item_id, text bytes) of about BATCH_BYTES; a batch is checked before it is
    collected and split further while it is more than twice as large."""
    items = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    size = F.octet_length("text").cast("long") + 16
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, -(-total // BATCH_BYTES))
    todo = [(parts, b) for b in range(parts)]
    while todo:
        parts, b = todo.pop()
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == b)
        n, held = part.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
        if n > 1 and held > 2 * BATCH_BYTES and parts < 1 << 40:
            todo += [(2 * parts, b), (2 * parts, b + parts)]
        elif n:
            yield [(r.item_id, bytes(r.text or b"")) for r in part.collect()]


def forward(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), ids and tfs of the known terms, ids ascending."""

    def run(batches):
        known = vocab.get
        for batch in batches:
            n, ids, tfs = [], [], []
            for raw in batch.column(1).to_pylist():
                words = terms(raw)
                held = Counter(map(known, words))
                held.pop(None, None)
                mine = sorted(held)
                n.append(len(words))
                ids.append(mine)
                tfs.append([held[i] for i in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "ids", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, ids array<int>, tfs array<int>")


class Block:
    """Documents of one block as a sparse matrix of impacts."""

    def __init__(self, batch, weights, coords, width, docs, total):
        self.doc = batch.column("doc_id").to_numpy()
        n = batch.column("n").to_numpy()
        ids, tfs = batch.column("ids"), batch.column("tfs")
        self.at = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
        self.ids = ids.flatten().to_numpy()
        tf = tfs.flatten().to_numpy().astype(np.int64)
        m = 25 + 75 * n * docs // total
        of = np.repeat(np.arange(len(n)), np.diff(self.at))
        self.impact = weights[self.ids] * (1_000_000_000 * tf // (1000 * tf + 8 * m[of]))
        sketch = np.zeros(len(n) * width, np.int64)
        np.maximum.at(sketch, of * width + coords[self.ids], self.impact)
        self.sketch = sketch.reshape(len(n), width)

    def exact(self, rows, counts):
        """Scores of some rows; ``counts`` holds the item's repeats by term id."""
        lens = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(lens)
        flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[rows] - (ends - lens), lens)
        sums = np.concatenate([[0], np.cumsum(self.impact[flat] * counts[self.ids[flat]])])
        return sums[ends] - sums[ends - lens]


def best(score, doc, k):
    """The k first by descending score, then ascending doc."""
    keep = np.lexsort((doc, -score))[:k]
    return score[keep], doc[keep]


def ranked(lists: DataFrame, items, vocab, weights, docs, total, k: int, width: int, rows: int) -> DataFrame:
    coords = np.array([zlib.crc32(t) % width for t in vocab], np.int64)
    asked = [Counter(vocab[t] for t in terms(text)) for _, text in items]

    def run(batches):
        held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in asked]
        tally = np.zeros(len(vocab), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                block = Block(batch.slice(low, rows), weights, coords, width, docs, total)
                folded = block.sketch.astype(np.float64)
                for first in range(0, len(asked), COLUMNS):
                    some = asked[first:first + COLUMNS]
                    ask = np.zeros((width, len(some)))
                    for j, counts in enumerate(some):
                        for t, c in counts.items():
                            ask[coords[t], j] += c
                    # doubles hold the sums exactly below 2 ** 53; beyond it the slack keeps bounds above
                    bounds = np.ascontiguousarray((folded @ ask).T)
                    bounds += np.where(bounds > 2 ** 53, bounds * 1e-9, 0)
                    for j, counts in enumerate(some):
                        held[first + j] = search(block, bounds[j], counts, tally, held[first + j])
        out = [(q, int(d), int(s)) for q, (score, doc) in enumerate(held) for s, d in zip(score, doc)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["q", "doc_id", "score"])

    def search(block, bound, counts, tally, state):
        score, doc = state
        floor = score[-1] if len(score) == k else 1
        todo = np.flatnonzero(bound >= floor)
        if not len(todo):
            return state
        todo = todo[np.lexsort((block.doc[todo], -bound[todo]))]
        for t, c in counts.items():
            tally[t] = c
        step = 4 * k
        while len(todo):
            now, todo = todo[:step], todo[step:]
            got = block.exact(now, tally)
            real = got > 0
            score, doc = best(np.concatenate([score, got[real]]), np.concatenate([doc, block.doc[now[real]]]), k)
            # they descend by (bound, -doc_id): the first that cannot enter ends the item's turn
            if len(score) == k and len(todo):
                b, d = bound[todo[0]], block.doc[todo[0]]
                if b < score[-1] or (b == score[-1] and d > doc[-1]):
                    break
            step = min(2 * step, 1024)
        for t in counts:
            tally[t] = 0
        return score, doc

    spark = lists.sparkSession
    found = lists.where("doc_id is not null and size(ids) > 0").mapInArrow(
        run, "q long, doc_id long, score long").withColumn("salt", F.spark_partition_id() % SALTS)
    order = [F.desc("score"), F.asc("doc_id")]
    for keys in (["q", "salt"], ["q"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            f"rank <= {int(k)}")
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(items)], "q long, item_id long")
    # one row an item of the bounded batch
    return found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


def rank_items(docs: DataFrame, items: DataFrame, k: int = 10, width: int = WIDTH, rows: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents, by sketches of ``width``
    coordinates over blocks of ``rows`` documents."""
    out = None
    for batch in item_batches(items):
        vocab = {t: i for i, t in enumerate(sorted(set(t for _, text in batch for t in terms(text))))}
        lists = spilled(forward(docs, vocab), "forward")
        n, total = lists.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n or not vocab:
            continue
        df = {r.id: r.df for r in lists.select(F.explode("ids").alias("id")).groupBy("id").agg(
            F.count("*").alias("df")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(i, 0) + 1)))
                            for i in range(len(vocab))], np.int64)
        part = ranked(lists, batch, vocab, weights, n, total, k, width, rows)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
m AS (SELECT doc_id, 100 - 75 + ((75 * len(t) * n_docs) // total) AS m FROM d, s WHERE len(t) > 0),
q AS (SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id)
      GROUP BY item_id, doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
             doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
