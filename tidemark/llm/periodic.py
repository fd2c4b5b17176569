"""Periodic run detection with multi-scale minimizers (operator 13).

A run is a maximal stretch of words with smallest period q and at least
max(12, 2 q) words. The texts of a task's chunk lie in one array of word numbers, with
a number of its own between two texts, so that nothing repeats across them.

* Periods below ``SHORT``: for each lag the array is compared with itself.
* Scale Q (64, 128, ...), periods Q to 2 Q - 1, texts of at least 2 Q words: hashes of
  Q / 4 words, the least of every window of Q - Q / 4 + 1 of them. A run's two copies
  hold the same window one period apart, so they hold equal minimizers at that distance:
  pairs of equal minimizers Q to 2 Q - 1 apart are the seeds. A seed whose surrounding
  half-scale block repeats at its distance has its text compared at that lag, which
  extends it to the whole stretch.
* Hashes that are periodic themselves (period at most Q / 8, known from smaller scales)
  are no minimizers; else a stretch of one word would pair with all of itself. A run
  made of them alone lies over two adjoining runs of one smaller period, and follows
  from their ends.

Equal stretches keep their smallest period. Hashes only choose what is compared; a result
rests on the words. Rows: one per input row; a null text has no words, a row
without doc_id is taken as it stands, repeated rows and ids are judged each, an empty
table gives no rows, other columns are not read. A task holds ``CHUNK`` words at a time,
or one text if that is longer.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SHORT = 64
CHUNK = 1_000_000
LEAST = 12
PLACE = np.uint64(28)
BELOW = (np.uint64(1) << PLACE) - np.uint64(1)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def lag_runs(a: np.ndarray, q: int):
    """Starts and ends of the stretches of ``a`` that keep period q and are long enough."""
    at = np.flatnonzero(a[q:] == a[:-q])
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1)
    start, end = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1
    keep = end - start >= max(q, LEAST - q)
    return start[keep], end[keep] + q


class Runs:
    """Found runs; a stretch is kept with the first, smallest period it is found with."""

    def __init__(self):
        self.start = self.end = self.period = np.empty(0, np.int64)
        self.keys = np.empty(0, np.int64)

    def add(self, start, end, q):
        if not len(start):
            return
        key = start.astype(np.int64) << 31 | end
        order = np.lexsort((q, key))
        order = order[np.append(True, key[order][1:] != key[order][:-1])]
        order = order[~np.isin(key[order], self.keys)]
        self.keys = np.concatenate([self.keys, key[order]])
        self.start = np.concatenate([self.start, start[order]])
        self.end = np.concatenate([self.end, end[order]])
        self.period = np.concatenate([self.period, np.broadcast_to(q, len(start))[order]])


def adjoining(a: np.ndarray, runs: Runs, scale: int):
    """Runs of ``scale`` to 2 scale - 1 over two runs of one period p <= scale / 8 that touch.

    Gives closed runs and, where ends of the two align, lags that need a comparison."""
    small = np.flatnonzero((runs.period <= scale // 8) & (runs.end - runs.start >= scale))
    small = small[np.lexsort((runs.start[small], runs.period[small]))]
    out, lags = [], []
    for i, j in zip(small[:-1], small[1:]):
        p, s, e, t, f = (int(x) for x in (runs.period[i], runs.start[i], runs.end[i], runs.start[j], runs.end[j]))
        if runs.period[j] != p or t > e:
            continue
        ring, word = np.tile(a[s:s + p], 2), a[t:t + p].tobytes()
        at = ring.tobytes().find(word)
        while at >= 0 and at % a.itemsize:
            at = ring.tobytes().find(word, at + 1)
        if at < 0:
            continue
        shift = (t - s - at // a.itemsize) % p
        d = np.arange(scale + (shift - scale) % p, min(2 * scale - 1, e - s, f - t) + 1, p)
        low, high = np.maximum(s, t - d), np.minimum(e, f - d)
        wide = high - low >= d
        even = (s == t - d) | (e == f - d)
        lags += [(s, int(x)) for x in d[even]]
        keep = wide & ~even
        out.append((low[keep], high[keep] + d[keep], d[keep]))
    return out, lags


def seeds(a: np.ndarray, runs: Runs, scale: int):
    """Positions and distances of equal minimizers whose blocks repeat."""
    k = scale // 4
    h = mixed(a.astype(np.uint64) + np.uint64(1))
    size = 1
    while size < k:
        h = mixed(h[:-size] * np.uint64(3) + h[size:])
        size *= 2
    block = mixed(h[:-k] * np.uint64(3) + h[k:])
    here = (runs.period <= k // 2) & (runs.end - runs.start >= k)
    steps = np.zeros(len(h) + 1, np.int64)
    np.add.at(steps, runs.start[here], 1)
    np.add.at(steps, runs.end[here] - k + 1, -1)
    key = (h & ~BELOW) | np.arange(len(h), dtype=np.uint64)
    key[np.cumsum(steps[:-1]) > 0] = TOP
    width, size, least = scale - k + 1, 1, key
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    chosen = np.zeros(len(h), bool)
    chosen[(least[least != TOP] & BELOW).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    at = at[np.argsort(h[at], kind="stable")]
    g = h[at]
    pos, dist, t = [], [], 1
    while t < len(at):
        d = at[t:] - at[:-t]
        near = (g[t:] == g[:-t]) & (d < 2 * scale)
        if not near.any():
            break
        near &= d >= scale
        pos.append(at[:-t][near])
        dist.append(d[near])
        t += 1
    if not pos:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pos, dist = np.concatenate(pos), np.concatenate(dist)
    half = 2 * k

    def repeats(x):
        ok = (x >= 0) & (x + dist < len(block))
        y = np.where(ok, x, 0)
        return ok & (block[y] == block[np.where(ok, y + dist, 0)])

    keep = repeats(pos) | repeats(pos - half)
    return pos[keep], dist[keep]


def find_runs(a: np.ndarray, first: np.ndarray, lens: np.ndarray) -> Runs:
    """Runs of all texts; text i takes ``lens[i]`` places from ``first[i]``, then one divider."""
    runs = Runs()
    longest = int(lens.max(initial=0))
    for q in range(1, min(SHORT - 1, longest // 2) + 1):
        start, end = lag_runs(a, q)
        runs.add(start, end, np.full(len(start), q))
    scale = SHORT
    while 2 * scale <= longest:
        texts = np.flatnonzero(lens >= 2 * scale)
        size = lens[texts] + 1
        base = np.cumsum(size) - size
        b = a[np.arange(size.sum()) + np.repeat(first[texts] - base, size)]
        # the runs so far in the places of b
        of = np.searchsorted(first, runs.start, "right") - 1
        slot = np.searchsorted(texts, of)
        mine = (slot < len(texts)) & (texts[np.minimum(slot, len(texts) - 1)] == of)
        move = (base - first[texts])[slot[mine]]
        local = Runs()
        local.start, local.end, local.period = runs.start[mine] + move, runs.end[mine] + move, runs.period[mine]
        closed, lags = adjoining(b, local, scale)
        pos, dist = seeds(b, local, scale)
        pos = np.concatenate([pos, np.array([p for p, _ in lags], np.int64)])
        dist = np.concatenate([dist, np.array([d for _, d in lags], np.int64)])
        text = np.searchsorted(base, pos, "right") - 1
        new = [(s, e, q, np.searchsorted(base, s, "right") - 1) for s, e, q in closed]
        for i, d in np.unique(np.stack([text, dist], 1), axis=0).tolist():
            start, end = lag_runs(b[base[i]:base[i] + size[i] - 1], d)
            new.append((start + base[i], end + base[i], np.full(len(start), d), np.full(len(start), i)))
        if new:
            start, end, q, i = (np.concatenate(x) for x in zip(*new))
            back = first[texts][i] - base[i]
            runs.add(start + back, end + back, q)
        scale *= 2
    return runs


def spliced(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of a row, made periodic from a place on for one tenth of the ids."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    reps = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * reps)[:n - a]


def scan(docs: DataFrame, rewrite=None) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    ``rewrite(doc_id, words)`` may replace the words of a row before they are searched."""

    def rows(ids, texts):
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        lens = np.array([len(w) for w in texts], np.int64)
        first = np.cumsum(lens + 1) - lens - 1
        a = np.empty(int((lens + 1).sum()), np.int64)
        for i, (words, low) in enumerate(zip(texts, first.tolist())):
            a[low:low + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            a[low + len(words)] = -1 - i
        runs = find_runs(a, first, lens)
        order = np.lexsort((runs.period, runs.start))
        start, end, period = runs.start[order], runs.end[order], runs.period[order]
        cuts = np.searchsorted(start, np.append(first, len(a)))
        for i, (doc_id, words) in enumerate(zip(ids, texts)):
            s, e, q = (x[cuts[i]:cuts[i + 1]] for x in (start, end, period))
            listed, top = "", (None,) * 4
            if len(s):
                s, e = s - first[i], e - first[i]
                size = e - s
                b = np.lexsort((q, s, -size))[0]
                top = int(s[b]), int(size[b]), int(q[b]), int(1000 * size[b] // q[b])
                listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), size.tolist(), q.tolist()))
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, s + q, 1)
                np.add.at(steps, e, -1)
                words = [words[j] for j in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
            yield (doc_id, len(s), *top, hashlib.sha256(listed.encode()).hexdigest(),
                   hashlib.sha256(b" ".join(words)).hexdigest())

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches):
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (raw or b"").split()
                ids.append(doc_id)
                texts.append(rewrite(doc_id, words) if rewrite else words)
                held += len(words) + 1
                if held > CHUNK:
                    yield pack(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield pack(ids, texts)

    def pack(ids, texts):
        cols = list(zip(*rows(ids, texts)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=[*names, "runs_sha256", "collapsed_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, ", ".join(f"{n} long" for n in names) + ", runs_sha256 string, collapsed_sha256 string")
