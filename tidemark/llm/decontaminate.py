"""Benchmark decontamination by template windows (operator 7).

Words become templates: numbers, unit words and names (capitalised words inside
a sentence) are typed placeholders. Windows of ``width`` template words are
hash-joined with the benchmark's. Matched windows of about the same shift
between document and item are one occurrence; its slots must be consistent:
one slot position of the item maps to one value. Windows of consistent
occurrences count towards the share of an item. An item of fewer than
``width`` words is one window of its own length, looked for in all documents,
with exact slots unless it is a whole document. Before the join
a bit table of fixed size, made of the benchmark's hashes, drops most windows
that cannot match; it only saves work, as the join decides.

Null and empty texts match nothing; rows without a key take no part; rows of
one doc_id are one document; an empty benchmark leaves all documents clean;
other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import cut_lineage

#: A word, with the mark that ends its sentence if one follows.
WORD = re.compile(r"[^\W_]+(?:[.!?\n]|\Z)?")
#: Unit words.
UNITS = frozenset("m cm mm km kg g mg lb s ms h min l ml usd eur dollars euros hours minutes days years percent".split())
P = 0x9E3779B97F4A7C15  # odd base of the window hashes
EDIT = 4  # words by which the shift of one occurrence may step
WORDS = 1 << 13  # words of a bit table sent to the driver in one row
VOCABULARY = 500_000  # distinct words a task remembers before it starts afresh


def kind(word: str, fresh: bool) -> str:
    """Placeholder of a word, or '' for an ordinary one."""
    if word[0].isdigit():
        return "<num>"
    if word.lower() in UNITS:
        return "<unit>"
    return "<name>" if word[0].isupper() and not fresh else ""


class Templates(dict):
    """Word to row of ``table``: its template code inside a sentence and at its
    start, and whether it ends one. Remembers at most ``VOCABULARY`` words
    between texts."""

    def __init__(self):
        self.table = np.zeros((1 << 12, 3), np.uint64)

    def __missing__(self, token: str) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        w = token.rstrip(".!?\n")
        self.table[at] = (*(xxhash.xxh64_intdigest(kind(w, f) or w.lower()) for f in (False, True)),
                          token[-1] in ".!?\n")
        self[token] = at
        return at

    def encode(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(words, whether each opens a sentence, template code of each, and as if it opened one)."""
        if len(self) > VOCABULARY:
            self.clear()
        tokens = WORD.findall(text)
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = self.table[at[:-1], 2] == 1
        return tokens, fresh, self.table[at, fresh.astype(np.int64)], self.table[at, 1]


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window, by differences of a running polynomial sum modulo
    2**64; fewer words than ``width`` make one window."""
    w = min(width, len(codes))
    if not w:
        return np.zeros(0, np.uint64)
    total = np.cumsum(codes * powers(P, len(codes)), dtype=np.uint64)
    h = total[w - 1:].copy()
    h[1:] -= total[:len(codes) - w]
    h *= powers(pow(P, -1, 1 << 64), len(h))
    h ^= h >> np.uint64(32)
    return h * np.uint64(P) + np.uint64(w)


def short_hashes(codes: np.ndarray, opening: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows whose first word counts as one that opens a sentence, as
    it does in an item; no window in fewer words."""
    n = len(codes) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = opening[:n].copy()
    for k in range(1, width):
        h += codes[k:k + n] * np.uint64(pow(P, k, 1 << 64))
    h ^= h >> np.uint64(32)
    return h * np.uint64(P) + np.uint64(width)


def slots(tokens: list[str], fresh: np.ndarray, i: int, width: int, opens: bool = False) -> tuple[str, list[int]]:
    """(values of the placeholders of window ``i``, tab-joined; their places in it);
    ``opens``: the first word counts as one that opens a sentence."""
    words = [(t.rstrip(".!?\n"), f) for t, f in zip(tokens[i:i + width], fresh[i:i + width])]
    found = [(w, kind(w, f or (opens and n == 0))) for n, (w, f) in enumerate(words)]
    return ("\t".join(w.lower() if k == "<unit>" else w for w, k in found if k),
            [n for n, (_, k) in enumerate(found) if k])


def windows(rows: DataFrame, key: str, width: int, bits: np.ndarray | None = None,
            short: tuple[int, ...] = ()) -> DataFrame:
    """(key, pos, h, slots, at, width, whole) of the windows; with ``bits``, of
    those whose bit is set, and of the ``short`` widths too."""
    table = None if bits is None else rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        templates = Templates()
        for pdf in batches:
            out = []
            for k, text in zip(pdf[key], pdf["text"]):
                tokens, fresh, codes, opening = templates.encode(text or "")
                full = min(width, len(tokens))
                if table is None or full == width:
                    sets = [(full, window_hashes(codes, width))]
                else:
                    sets = []
                sets += [(w, short_hashes(codes, opening, w)) for w in short]
                for w, h in sets:
                    if table is None:
                        keep = range(len(h))
                    else:
                        b = h & np.uint64(len(table.value) * 64 - 1)
                        word = table.value[(b >> np.uint64(6)).astype(np.int64)]
                        keep = np.flatnonzero((word >> (b & np.uint64(63))) & np.uint64(1))
                    signed = h.astype(np.int64)
                    out += [(k, int(i), int(signed[i]), *slots(tokens, fresh, i, w, w < width), w, w == len(tokens))
                            for i in keep]
            yield pd.DataFrame(out, columns=[key, "pos", "h", "slots", "at", "width", "whole"])

    return rows.where(F.col(key).isNotNull()).select(key, "text").mapInPandas(
        run, f"{key} long, pos int, h long, slots string, at array<int>, width int, whole boolean")


def bit_table(hashes: DataFrame, size: int) -> np.ndarray:
    """``size`` bits (a power of two), those of the hashes set. However many hashes there are, the
    driver receives a row for each ``WORDS`` words of 64 bits, with the 12 bytes (place, bits) of each
    word that is not 0: as rows of their own a million words would take it several hundred MB."""
    b = F.col("h").bitwiseAND(size - 1)
    words = hashes.groupBy(F.shiftright(b, 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("word"))
    packed = F.concat(F.lpad(F.hex("at"), 8, "0"), F.lpad(F.hex("word"), 16, "0"))
    out = np.zeros(size // 64, np.uint64)
    for r in words.groupBy(F.floor(F.col("at") / WORDS).alias("block")).agg(
            F.unhex(F.array_join(F.collect_list(packed), "")).alias("words")).select("words").collect():
        got = np.frombuffer(r.words, [("at", ">u4"), ("word", ">u8")])
        out[got["at"]] = got["word"]
    return out


def contamination(docs: DataFrame, bench: DataFrame, width: int = 8, share: float = 0.5,
                  bits: int = 1 << 24) -> DataFrame:
    """doc_id, item_id, matched, total, exact_slots of items whose windows a
    document holds to at least ``share``, with consistent slots."""
    b = windows(bench, "item_id", width).select(
        "item_id", "h", "at", "width", F.col("slots").alias("b_slots"), F.col("pos").alias("b_pos"))
    total = b.groupBy("item_id").agg(F.countDistinct("b_pos").alias("total"))
    short = tuple(r.width for r in b.where(F.col("width") < width).select("width").distinct().collect())
    pair = ["doc_id", "item_id"]
    exact = F.col("slots") == F.col("b_slots")
    found = windows(docs, "doc_id", width, bit_table(b, bits), short).drop("at", "width")
    # few rows, read twice below: written once, so that the texts are read once
    by_shift = Window.partitionBy(*pair).orderBy("shift")
    step = F.col("shift") - F.lag("shift").over(by_shift)
    hits = cut_lineage(
        found.join(b, "h").where((F.col("width") == width) | exact | F.col("whole")).join(total, "item_id")
        .withColumn("shift", F.col("pos") - F.col("b_pos"))
        .withColumn("new", (F.coalesce(step, F.lit(0)) > F.least(F.lit(EDIT), F.col("total") - 1)).cast("int"))
        .withColumn("occ", F.sum("new").over(by_shift)))
    pairs = F.explode(F.arrays_zip("at", F.split("b_slots", "\t").alias("a"), F.split("slots", "\t").alias("b")))
    clash = (hits.where(F.size("at") > 0).select(*pair, "occ", "b_pos", pairs.alias("p"))
             .groupBy(*pair, "occ", (F.col("b_pos") + F.col("p.at")).alias("place"))
             .agg(F.min("p.b").alias("lo"), F.max("p.b").alias("hi")).groupBy(*pair, "occ")
             .agg(F.avg((F.col("lo") != F.col("hi")).cast("double")).alias("clash")))
    same = hits.groupBy(*pair, "occ").agg(F.min(exact).alias("same"))
    kept = (hits.join(same, [*pair, "occ"]).join(clash, [*pair, "occ"], "left")
            .where(F.col("same") | (F.coalesce("clash", F.lit(0.0)) <= 0.5)))
    need = share * F.col("total")
    return (kept.groupBy(*pair, "total").agg(
        F.countDistinct("b_pos").alias("matched"),
        F.countDistinct(F.when(F.col("same"), F.col("b_pos"))).alias("n_same"))
        .where(F.col("matched") >= need)
        .select("doc_id", "item_id", "matched", (F.col("n_same") >= need).alias("exact_slots"), "total"))
