"""Suffix-array removal of repeated byte strings (operator 5).

Every ``size``-byte window is routed by its minimiser, an anchor that depends
on the window's bytes alone, so equal windows meet. Anchors that occur once are
settled; of the rest, distinct segments form shards. Each shard builds a
suffix array by prefix doubling that re-sorts unsettled groups only, and
Kasai's common prefixes of neighbours show repeated windows.

An anchor that stands in more than ``split`` different segments would make a shard
too large. Its windows are divided by their distance from the anchor, a step of
``width`` bytes at a time, and routed anew by the bytes that all windows of a step
have in common; what is still too large is divided by narrower steps, down to single
windows. Equal windows have equal anchors and distances, so they always meet.

Null texts are empty; repeated rows repeat each other's bytes; an empty table gives
no rows; a run of a short period keeps one anchor and makes a segment for each
``size - K + 1`` windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.neardup import spilled
from tidemark.session import cut_lineage

K = 48
WIDTHS = (45, 7, 1)  # steps of the distance from an anchor, for anchors in too many segments
BASE = 0x9E3779B97F4A7C15  # odd base of the gram hashes
PACK = 7  # symbols of the first sort key


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def string_hashes(b: np.ndarray):
    """The function (starts, ends) -> 64-bit hashes of those strings, by differences of a
    running polynomial sum. Starts and ends are arrays or slices of positions."""
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b + np.uint64(1)) * _powers(BASE, len(b)), dtype=np.uint64, out=total[1:])
    back = _powers(pow(BASE, -1, 1 << 64), len(b) + 1)
    return lambda start, end: _mix((total[end] - total[start]) * back[start])


def _windows(text: bytes, size: int):
    """The hashing function, the K-byte strings' hashes, and each window's anchor: the
    first of its K-byte strings of least hash."""
    of = string_hashes(np.frombuffer(text, np.uint8))
    h, w = of(slice(0, len(text) - K + 1), slice(K, len(text) + 1)), size - K + 1
    key = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    pad = np.concatenate([key, np.full(-len(key) % w, ~np.uint64(0))]).reshape(-1, w)
    pre = np.minimum.accumulate(pad, axis=1).ravel()
    suf = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(text) - size + 1
    return of, h, (np.minimum(suf[:n], pre[w - 1:w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(text: bytes, size: int) -> tuple[np.ndarray, ...]:
    """Starts, ends, anchor hashes, content hashes and weights of the segments: consecutive
    windows whose anchors are the same string, ``size - K + 1`` at most. The weight is 2
    where the anchor itself moves on, as the segment may then repeat its own windows."""
    if len(text) < size:
        return (np.zeros(0, np.int64),) * 5
    of, h, at = _windows(text, size)
    n, h = len(at), h[at].view(np.int64)
    new = np.diff(h, prepend=~h[:1]) != 0
    i = np.arange(n)
    cut = np.flatnonzero((i - np.maximum.accumulate(np.where(new, i, 0))) % (size - K + 1) == 0)
    last = np.append(cut[1:], n) - 1
    return cut, last + size, h[cut], of(cut, last + size).view(np.int64), 1 + (at[last] != at[cut])


def pieces(text: bytes, size: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and routing hashes of runs of windows with the same anchor at distances
    from the same step: the hash of the bytes that all windows of the step share."""
    of, _, at = _windows(text, size)
    n = len(at)
    step = (at - np.arange(n)) // width
    cut = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(step, prepend=-1) != 0))
    core = at[cut] - step[cut] * width
    g = of(core, core + size - width + 1) + step[cut].astype(np.uint64) * np.uint64(BASE)
    return cut, np.append(cut[1:], n) + size - 1, _mix(g).view(np.int64)


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Sorted suffixes of ``x``, whose bytes are 0 to 255 and whose other symbols,
    below 0, end texts: each of them is unlike all others, earlier ones sort first.
    The first key packs ``PACK`` symbols up to an end; refinement then doubles the
    length and sorts the groups that are still unsettled alone."""
    n = len(x)
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    symbols = np.concatenate([np.maximum(x, -1) + 1, np.zeros(PACK, np.int64)])
    for i in range(PACK):
        ended |= symbols[i:i + n] == 0
        key = key << 9 | np.where(ended, 0, symbols[i:i + n])
    sa = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = (key[sa[1:]] != key[sa[:-1]]) | ended[sa[1:]] | ended[sa[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h, i = PACK, np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(i):
        s = sa[i]
        key = rank[s] * n + rank[s + h]
        order = np.argsort(key)
        s, key = s[order], key[order]
        sa[i] = s
        new = np.ones(len(s), bool)
        new[1:] = key[1:] != key[:-1]
        rank[s] = i[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
        i = i[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


def common_prefixes(x: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, length) of each position: the suffix sorted just before it, -1 for
    the first, and the length of their common prefix. Kasai's lemma: where the
    symbols to the left of both agree, the length is that of the position to the
    left less one; only the other positions are compared. ``sa`` is fully sorted
    and the last symbol of ``x`` occurs once."""
    before = np.full(len(x), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(len(x))
    known = (i > 0) & (before > 0)
    known[known] = x[i[known] - 1] == x[before[known] - 1]
    start = np.flatnonzero(~known)
    length = np.zeros(len(x), np.int64)
    live, n = start[before[start] >= 0], 0
    while len(live):
        live = live[x[live + n] == x[before[live] + n]]
        n += 1
        length[live] = n
    last = start[np.cumsum(~known) - 1]
    return before, length[last] - (i - last)


def repeated(x: np.ndarray, size: int) -> np.ndarray:
    """Whether each position starts a ``size``-symbol string that starts elsewhere too."""
    before, length = common_prefixes(x, suffix_array(x))
    hit = length >= size
    hit[before[hit]] = True
    return hit


def _shard(pdf: pd.DataFrame, size: int, width: int) -> pd.DataFrame:
    """Repeated runs of a shard's distinct segments, and the pieces, ``width`` steps long, of
    those marked hot. A segment that is alone with its anchor and has copies repeats wholly
    and needs no sorting."""
    rows = [(h, md, n, None, None, s, g, hashlib.md5(c[s:e]).digest(), c[s:e])
            for h, md, n, c, hot in zip(pdf["h"], pdf["md"], pdf["n"], pdf["content"], pdf["hot"]) if hot
            for s, e, g in zip(*(x.tolist() for x in pieces(c, size, width)))]
    pdf = pdf[~pdf["hot"].to_numpy(bool)]
    easy = ~pdf["h"].duplicated(keep=False).to_numpy() & (pdf["n"] > 1).to_numpy()
    whole = pdf[easy]
    rows += [(h, md, n, [0], [len(c)], None, None, None, None)
             for h, md, n, c in zip(whole["h"], whole["md"], whole["n"], whole["content"])]
    pdf = pdf[~easy]
    if len(pdf):
        parts, at = [], 0
        for i, c in enumerate(pdf["content"]):
            parts += [np.frombuffer(c, np.uint8).astype(np.int64), np.array([-1 - i])]
        flag = repeated(np.concatenate(parts), size)
        for h, md, n, c in zip(pdf["h"], pdf["md"], pdf["n"], pdf["content"]):
            hit = flag[at:at + len(c) - size + 1] | (n > 1)
            at += len(c) + 1
            edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
            if len(edge):
                rows.append((h, md, n, edge[::2].tolist(), (edge[1::2] + size - 1).tolist(), None, None, None, None))
    return pd.DataFrame(rows, columns=["h", "md", "n", "lo", "hi", "at", "g", "g_md", "content"]
                        ).astype({"at": "Int32", "g": "Int64"})


def _meet(left: DataFrame, right: DataFrame, on: list[str], total: int, spread: list[str]) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose column n counts each key's rows of
    ``left``, ``total`` in all. Keys of more than a thousandth of the rows, a thousand of
    them at most, are told to ``left`` by broadcast and salted by its columns ``spread``."""
    right = right.withColumn("salts", F.floor(F.col("n") * 1000 / max(total, 1)).cast("int") + 1).drop("n")
    heavy = F.broadcast(right.where("salts > 1").select(*on, "salts"))
    left = left.join(heavy, on, "left").withColumn(
        "salt", F.pmod(F.xxhash64(*spread), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return left.join(right, [*on, "salt"]).drop("salt")


def _settle(d: DataFrame, size: int, shards: int, split: int, widths: tuple[int, ...]) -> DataFrame:
    """h, md, n, lo, hi (arrays): repeated runs of the distinct segments h, md, n, content, hot.
    Hot ones lie in shards of their own choice and are divided; none may be hot where
    ``widths`` is empty."""
    width = widths[0] if widths else size
    by = F.when(F.col("hot"), F.xxhash64("h", "md")).otherwise(F.xxhash64("h"))
    out = cut_lineage(d.withColumn("shard", F.pmod(by, F.lit(shards))).groupBy("shard").applyInPandas(
        lambda pdf: _shard(pdf, size, width),
        "h long, md binary, n long, lo array<int>, hi array<int>, at int, g long, g_md binary, content binary"))
    hits = out.where("g is null").select("h", "md", "n", "lo", "hi")
    if not widths:
        return hits
    small = out.where("g is not null").select(
        F.col("h").alias("up"), F.col("md").alias("up_md"), "n", "at", F.col("g").alias("h"), F.col("g_md").alias("md"), "content")
    found = cut_lineage(small.groupBy("h", "md").agg(
        F.sum("n").alias("copies"), F.count("*").alias("rows"), F.first("content").alias("content")))
    crowded = (F.count("*") > split) & F.lit(len(widths) > 1)
    counts = cut_lineage(found.groupBy("h").agg(
        F.count("*").alias("n"), F.sum("copies").alias("copies"), crowded.alias("hot")).where("copies > 1").drop("copies"))
    kinds, rows = found.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    deeper = () if counts.where("hot").isEmpty() else widths[1:]
    below = _meet(found.select("h", "md", "copies", "content"), counts, ["h"], kinds, ["md"]).withColumnRenamed("copies", "n")
    sub = _settle(below, size, shards, split, deeper).drop("n").join(
        found.select("h", "md", F.col("rows").alias("n")), ["h", "md"])
    spans = _meet(small.withColumnRenamed("n", "copies").drop("content"), cut_lineage(sub), ["h", "md"], rows, ["up_md", "at"])
    shift = lambda c: F.flatten(F.collect_list(F.transform(c, lambda x: x + F.col("at"))))
    return cut_lineage(hits.unionByName(spans.groupBy(F.col("up").alias("h"), F.col("up_md").alias("md")).agg(
        F.first("copies").alias("n"), shift("lo").alias("lo"), shift("hi").alias("hi"))))


def dedup(docs: DataFrame, size: int = 400, shard_bytes: int = 1 << 18, split: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row. There is a
    shard for each ``shard_bytes`` of text, so that shards keep their size."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = 1 + total // shard_bytes
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("key", F.xxhash64("doc_id", "text"))

    def anchors(batches):
        for pdf in batches:
            found = [segments(t.encode(), size) for t in [*pdf["text"], ""]]
            yield pd.DataFrame({"key": np.repeat(pdf["key"].to_numpy(), [len(x[0]) for x in found[:-1]]),
                                "start": np.concatenate([x[0] for x in found]),
                                "h": np.concatenate([x[2] for x in found]),
                                "m": np.concatenate([x[3] for x in found]),
                                "n": np.concatenate([x[4] for x in found])})

    def content(batches):
        for pdf in batches:
            rows = []
            for k, t, want, crowded in zip(pdf["key"], pdf["text"], pdf["want"], pdf["crowded"]):
                t = t.encode()
                cuts = segments(t, size)
                pick, hot = np.isin(cuts[0], want), np.isin(cuts[0], crowded)
                rows += [(k, s, h, hashlib.md5(t[s:e]).digest(), w, t[s:e])
                         for s, e, h, w in zip(*(c[pick].tolist() for c in (*cuts[:3], hot)))]
            yield pd.DataFrame(rows, columns=["key", "start", "h", "md", "hot", "content"])

    # written, as a second pass over the texts costs more than these columns
    narrow = spilled(base.select("key", "text").mapInPandas(
        anchors, "key long, start int, h long, m long, n long"), "anchors")
    # anchors with several contents in more than ``split`` segments are divided
    counts = cut_lineage(narrow.groupBy("h").agg(
        F.sum("n").alias("n"), ((F.count("*") > split) & (F.min("m") < F.max("m"))).alias("hot")).where("n > 1"))
    shared, crowded = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("hot"), F.lit(False))).first()
    want = _meet(narrow.select("key", "start", "h"), counts, ["h"], shared, ["key", "start"]).groupBy("key").agg(
        F.collect_set("start").alias("want"), F.collect_set(F.when(F.col("hot"), F.col("start"))).alias("crowded"))
    # the columns of the last join, so that the texts are shuffled once
    segs = base.join(want, "key").mapInPandas(
        content, "key long, start int, h long, md binary, hot boolean, content binary")
    d = segs.groupBy("h", "md").agg(F.count("*").alias("n"), F.first("hot").alias("hot"), F.first("content").alias("content"))
    hits = _settle(d, size, shards, split, WIDTHS if crowded else ())
    spans = _meet(segs.select("key", "start", "h", "md"), hits, ["h", "md"], shared, ["key", "start"]).select(
        "key", "start", F.explode(F.arrays_zip("lo", "hi")).alias("x")).groupBy("key").agg(
        F.collect_set(F.struct((F.col("start") + F.col("x.lo")).alias("lo"), (F.col("start") + F.col("x.hi")).alias("hi"))).alias("r"))

    def cut(batches):
        for pdf in batches:
            rows = []
            for d, t, r in zip(pdf["doc_id"], pdf["text"], pdf["r"]):
                t = t.encode()
                gone = np.zeros(len(t), bool)
                for x in (r if r is not None else ()):
                    gone[x["lo"]:x["hi"]] = True
                left = np.frombuffer(t, np.uint8)[~gone].tobytes()
                rows.append((d, len(t), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()),
                             hashlib.sha256(left).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                               ).astype({"doc_id": "Int64"})

    return base.join(spans, "key", "left").select("doc_id", "text", "r").mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
