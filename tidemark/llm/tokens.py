"""Token counts by rank-synchronous merging of ragged arrays (operator 11).

Texts are cut into pre-tokens; the pre-tokens not counted before in this task lie
as byte symbols in one ragged numpy array. Each round finds every sequence's lowest
merge rank, applies that pair in all sequences at once and drops the finished
sequences; the symbols that survive are the tokens. Pre-tokens of more than
``LONG`` bytes would need many rounds over long arrays: there the positions wait in
lists by rank, so that a round touches only the pairs it merges.

The merge table of a tokenizer file (a few hundred KB whatever the input) goes to
the tasks with the function. Rows: one per input row; a null text counts as empty,
a null doc_id stays null, repeated rows and ids are counted each, an empty table
gives no rows, columns other than doc_id and text are not read. Bytes that are not
UTF-8 count as U+FFFD. Memory of a task: ``SLICE`` characters of pre-tokens at a time
and a cache of ``CACHE`` counts.
"""

from __future__ import annotations

import heapq
import json
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# The pre-token pattern and byte alphabet of byte-level BPE files.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

NONE = np.iinfo(np.int32).max
LONG = 2048
SLICE = 2_000_000
CACHE = 300_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in -> byte; bytes without a glyph take 256, 257, ... in order."""
    hidden = [b for b in range(256) if b not in set(VISIBLE)]
    return {chr(b): b for b in VISIBLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Sorted pair keys of a byte-level BPE file with their ranks; symbols are numbered
    bytes first, then merges by rank, so that a merge of rank r makes symbol 256 + r."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with stripping are not supported")
        number = byte_alphabet()
        pairs = np.empty((len(model["merges"]), 2), np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            # a KeyError here would mean a part that no earlier merge has made
            pairs[rank] = number[a], number[b]
            if a + b in number:
                raise ValueError(f"{path}: two merges make {a + b!r}")
            number[a + b] = 256 + rank
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def leftmost(touch: np.ndarray) -> np.ndarray:
    """Which of the ordered candidates merge when ``touch[i]`` says that i overlaps i - 1:
    every second one of a chain, from its left end."""
    at = np.arange(len(touch))
    head = np.maximum.accumulate(np.where(touch, 0, at))
    return (at - head) % 2 == 0


def count_ragged(m: Merges, pieces: list[bytes]) -> np.ndarray:
    """Symbols left of each non-empty piece; one round merges each piece's lowest rank."""
    lens = np.array([len(p) for p in pieces], np.int64)
    done = lens.copy()
    who = np.arange(len(pieces))
    sym = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
    last = np.cumsum(lens) - 1
    rank = np.full(len(sym), NONE, np.int32)
    if len(sym) > 1:
        rank[:-1] = m.rank(sym[:-1], sym[1:])
    rank[last] = NONE
    while len(who):
        start = np.cumsum(lens) - lens
        low = np.minimum.reduceat(rank, start)
        live = low < NONE
        if not live.all():
            done[who[~live]] = lens[~live]
            keep = np.repeat(live, lens)
            sym, rank = sym[keep], rank[keep]
            who, lens, low = who[live], lens[live], low[live]
            if not len(who):
                break
        of = np.repeat(np.arange(len(who)), lens)
        at = np.flatnonzero(rank == low[of])
        at = at[leftmost(np.diff(at, prepend=-2) == 1)]
        sym[at] = 256 + low[of[at]]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        lens = lens - np.bincount(of[at], minlength=len(who))
        place = np.cumsum(keep) - 1
        sym, rank, of, at = sym[keep], rank[keep], of[keep], place[at]
        again = np.unique(np.concatenate([at, at[at > 0] - 1]))
        inner = again[again + 1 < len(sym)]
        rank[again] = NONE
        inner = inner[of[inner] == of[inner + 1]]
        rank[inner] = m.rank(sym[inner], sym[inner + 1])
    return done


def count_long(m: Merges, piece: bytes) -> int:
    """The same for one long piece: linked positions wait in lists by rank."""
    n = len(piece)
    sym = np.append(np.frombuffer(piece, np.uint8).astype(np.int64), -1)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    rank = np.full(n + 1, NONE, np.int32)
    rank[:n] = m.rank(sym[:-1], sym[1:])
    rank[n - 1] = NONE
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enlist(at):
        at = at[rank[at] < NONE]
        at = at[np.argsort(rank[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank[at])) + 1
        for group in np.split(at, cuts) if len(at) else ():
            r = int(rank[group[0]])
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(heap, r)
            waiting[r].append(group)

    enlist(np.arange(n))
    left = n
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[rank[at] == r]
        if not len(at):
            continue
        touch = np.zeros(len(at), bool)
        touch[1:] = after[at[:-1]] == at[1:]
        at = at[leftmost(touch)]
        gone = after[at]
        far = after[gone]
        sym[at], after[at], rank[gone] = 256 + r, far, NONE
        before[far] = at
        left -= len(at)
        changed = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
        nxt = after[changed]
        rank[changed] = np.where(nxt < n, m.rank(sym[changed], sym[np.minimum(nxt, n)]), NONE)
        enlist(changed)
    return left


def slices(parts, pattern):
    """Lists of pre-tokens of about SLICE characters; no text is held twice."""
    for part in parts:
        if len(part) <= SLICE:
            yield pattern.findall(part)
        else:
            found = (hit[0] for hit in pattern.finditer(part))
            while some := list(islice(found, SLICE // 4)):
                yield some


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` by the tokenizer file."""
    m = Merges(path)

    def run(batches):
        pattern = regex.compile(SPLIT)
        special = regex.compile("|".join(regex.escape(s) for s in sorted(m.special, key=len, reverse=True))
                                or r"(?!)")
        known: dict[str, int] = {}

        def learn(new):
            if len(known) > CACHE:
                known.clear()
            raw = [p.encode() for p in new]
            short = [i for i, p in enumerate(raw) if len(p) <= LONG]
            for i, c in zip(short, count_ragged(m, [raw[i] for i in short]).tolist() if short else ()):
                known[new[i]] = c
            return {p: count_long(m, b) for p, b in zip(new, raw) if len(b) > LONG}

        def total(lists):
            """Token sums of several lists, whose new pre-tokens are merged together."""
            fresh = set().union(*lists).difference(known)
            if len(known) + len(fresh) > CACHE:
                known.clear()
                fresh = set().union(*lists)
            rare = learn(list(fresh)) if fresh else {}
            get = known.__getitem__ if not rare else (lambda p: rare[p] if p in rare else known[p])
            return [sum(map(get, some)) for some in lists]

        for batch in batches:
            raws = batch.column(1).to_pylist()
            counts = [0] * len(raws)
            rows, lists, size = [], [], 0

            def flush():
                nonlocal size
                for i, c in zip(rows, total(lists) if lists else ()):
                    counts[i] += c
                rows.clear()
                lists.clear()
                size = 0

            for i, raw in enumerate(raws):
                text = (raw or b"").decode("utf-8", "replace")
                parts = special.split(text)
                counts[i] += len(parts) - 1
                for some in slices(parts, pattern):
                    rows.append(i)
                    lists.append(some)
                size += len(text)
                if size > SLICE:
                    flush()
            flush()
            n_bytes = [len(r or b"") for r in raws]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
