"""Toxicity by class-conditional Kneser-Ney models (operator 1).

For each class chained models give the probability of a word, letter by letter from its
beginning to its end mark, and of the word that follows one or two others. Counts are over distinct words (and phrases)
of each labelled document. A step from context p to x has in class c the probability

    (max(n_c(px) - D, 0) + (THETA + D T_c(p)) q(x)) / (N_c(p) + THETA)

T_c counts the distinct followers of p. The backoff q is shared: the Kneser-Ney continuation count, in how many
distinct contexts x follows the same two letters (for words: any word, for third words the word before). With ``recursive``,
as the query asks, it is itself discounted by ``DELTA`` and backs off to the continuation count after
one letter, that to the count after any, and that (as for words) to equal shares.

Two statistics make the score, by a logistic curve fitted on one label fold:

- The whole text's log-likelihoods under the letter models of both classes, their difference divided by its number of
  words (``letter_weights``). Every word counts as often as it stands there, and every labelled word of either class is in the
  models; what is not is backed off to.
- The largest log ratio a word of the text's expressions (words, their beginnings, phrases of two and three words), as
  a few insults vanish in the mean of a long text (``train``). Here followers seen in at most D toxic documents' words
  are one rare symbol, so that chance expressions are smoothed alike in both classes: D of the count is discounted, so such
  expressions have no likelihood of their own. The query has no floor for the ratio; ``FLOOR`` is the plain form's.

Counts are Spark tables keyed by 64-bit hashes (words by themselves), which grow with the distinct
expressions and are joined; log ratios of expressions are summed along the chains by doubling
jumps. Each table is written and read again as Parquet (``spilled``): Spark reads small files together, so that a
small table is dealt out by few tasks, whatever the number of shuffle partitions. Texts are scored in one pass: the
highest ``TABLE`` rows of each model go to the tasks, what may meet a lower row (by a bit table of bounded
size) is joined with these. Without labels of both classes in the calibrating
fold, texts without expressions of ``FLOOR`` score the share of toxic labels, at most 0.25, so they are
never rejected. A null or empty text has no expressions and the mean of the ordinary calibrating texts. Rows of one
doc_id are one document and share their statistics, rows without a key are scored each by its text; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.decontaminate import VOCABULARY, bit_table, powers
from tidemark.llm.neardup import spilled

WORD = re.compile(r"[^\W\d_]+|\d+")
D = 1.0  # a toxic expression of one document is no evidence
THETA = 20.0  # further mass of the shared backoff, in counts
DELTA = 0.75  # discount of the continuation counts
FLOOR = 2.0  # a log ratio a word below this is no evidence
P = np.uint64(0x9E3779B97F4A7C15)
ROOT = 0x5851F42D4C957F2D  # context of first letters
END = 0x1FFFFF  # end mark of a word, above every code point
ANY = -1  # context of words in a phrase, for continuation counts
CHARS = 2_000_000  # characters hashed at once
SALTS = 16
TABLE = 1 << 21  # rows of a model sent to the tasks
UNIT = 1 << 24  # weights are whole multiples of 1 / UNIT, so that sums do not depend on their order
NODE = ["h", "up", "ctx", "tail", "tctx", "words"]
PART = "k long, anon boolean, h long, salt long, times long, rows long, words long, total double, top double"


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * P
    return h ^ (h >> np.uint64(29))


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    b = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) == 1


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Numbers first, first + 1, ... (``many`` of each), one after another."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


def follow(h: np.ndarray) -> np.ndarray:
    """Context key of what follows an expression of whole words."""
    return mix(h ^ np.uint64(ROOT))


class Grams(dict):
    """Word to its number. Of each word: the hash of the whole word (``table``) and the range
    (``first``, ``many``) of its beginnings in ``stems``; with ``bits``, of those whose bit is set.
    With ``full``, ``more`` holds (up, tail, tctx) of each beginning and ``whole`` of each word.
    Phrases have at most ``longest`` words, two or three. Remembers at most ``VOCABULARY`` words between batches."""

    def __init__(self, bits: np.ndarray | None = None, full: bool = False, longest: int = 2):
        self.bits, self.full, self.longest = bits, full, longest
        self.forget()

    def forget(self):
        self.clear()
        self.table, self.stems = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first = self.many = np.zeros(0, np.int64)
        self.more = self.whole = np.zeros((3, 0), np.int64)

    def marked(self, h: np.ndarray) -> np.ndarray:
        """Whether the bit of each hash is set; without bits, all are."""
        return np.ones(len(h), bool) if self.bits is None else marked(self.bits, h)

    @staticmethod
    def hashed(words: list[str]):
        """Hashes of words and of their beginnings, by a running polynomial sum: (word; the beginnings', one
        word's after another's: hash, number of the word, letters; code points; first of each word, its size)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        c = letters.astype(np.uint64)
        start = np.cumsum(size) - size
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(c) * powers(int(P), len(c)), dtype=np.uint64)])
        back = powers(pow(int(P), -1, 1 << 64), len(c))[start]
        word = mix((total[start + size] - total[start]) * back + size.astype(np.uint64))
        of = np.repeat(np.arange(len(words)), size)
        long = np.arange(len(of)) - start[of] + 1
        stem = mix(~mix((total[1:] - total[start[of]]) * back[of] + long.astype(np.uint64)))
        return word, stem, of, long, letters, start, size

    def learn(self, words: list[str]):
        """Hashes of new words and their beginnings."""
        word, stem, of, long, letters, start, size = self.hashed(words)
        keep = self.marked(stem)
        many = np.bincount(of[keep], minlength=len(words))
        self.first = np.concatenate([self.first, len(self.stems) + np.cumsum(many) - many])
        self.many = np.concatenate([self.many, many])
        self.stems = np.concatenate([self.stems, stem[keep]])
        self.table = np.concatenate([self.table, word])
        if self.full:
            one = letters.astype(np.int64) + 1
            prev1 = np.where(long > 1, np.roll(one, 1), 0)
            prev2 = np.where(long > 2, np.roll(one, 2), 0)
            up = np.where(long > 1, np.roll(stem, 1), np.uint64(ROOT)).view(np.int64)
            pair = (prev1 << 21) | prev2
            self.more = np.concatenate([self.more, np.stack([up, (one << 42) | pair, pair])[:, keep]], axis=1)
            last = start + size - 1
            pair = (one[last] << 21) | prev1[last]
            self.whole = np.concatenate([self.whole, np.stack([stem[last].view(np.int64), (END << 42) | pair, pair])], axis=1)

    def tokens(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(number of the text, number of the word) of all words, in order."""
        if len(self) > VOCABULARY:
            self.forget()
        tokens = [WORD.findall((t or "").lower()) for t in texts]
        new = [w for w in set().union(*tokens) if w not in self]
        if new:
            self.learn(new)
            self.update(zip(new, range(len(self), len(self) + len(new))))
        sizes = [len(words) for words in tokens]
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(tokens)), np.int64, sum(sizes))
        return np.repeat(np.arange(len(tokens)), sizes), at

    def phrases(self, doc: np.ndarray, w: np.ndarray):
        """(words after the first, hash, hash of what it continues) of the phrases of each size, of any two or more words
        in a row; those over the end of a text too."""
        h = w
        for k in range(1, self.longest):
            up, h = h[:-1], mix(h[:-1] * P + w[k:])
            yield k, h, up

    def read(self, texts):
        """(doc, at): distinct words of each text; then of its phrases of each size (doc, hash, hash of what it
        continues, of its last word, of its last two), repeats once."""
        doc, at = self.tokens(texts)
        w = self.table[at]
        single = np.unique(doc * max(len(self), 1) + at)
        out = []
        for k, h, up in self.phrases(doc, w):
            here = np.flatnonzero((doc[k:] == doc[:max(len(doc) - k, 0)]) & (self.marked(h) | self.marked(follow(up))))
            here = here[np.lexsort((h[here], doc[here]))]
            new = np.ones(len(here), bool)
            new[1:] = (doc[here[1:]] != doc[here[:-1]]) | (h[here[1:]] != h[here[:-1]])
            here = here[new]
            out.append((doc[here], h[here], up[here], w[here + k], w[here + k - 1]))
        return (single // max(len(self), 1), single % max(len(self), 1)), out

    def tally(self, texts) -> pd.DataFrame:
        """(h, n) of the expressions and contexts whose bit is set: distinct words (phrases) of a text, over all texts."""
        (_, at), phrases = self.read(texts)
        at, n = np.unique(at, return_counts=True)
        hashes = [self.stems[spread(self.first[at], self.many[at])], self.table[at], np.full(1, ROOT, np.uint64)]
        counts = [np.repeat(n, self.many[at]), n, np.full(1, n.sum())]
        for _, h, up, _, _ in phrases:
            hashes += [h, follow(up)]
            counts += [np.ones(len(h), np.int64)] * 2
        h, n = np.concatenate(hashes), np.concatenate(counts)
        keep = self.marked(h)
        h, inverse = np.unique(h[keep].view(np.int64), return_inverse=True)
        return pd.DataFrame({"h": h, "n": np.bincount(inverse, n[keep], len(h)).astype(np.int64)})

    def nodes(self, texts) -> pd.DataFrame:
        """The distinct expressions whose bit is set, as ``NODE``: what they continue, their context,
        the keys of their continuation counts, their number of words."""
        (_, at), phrases = self.read(texts)
        at = np.unique(at)
        s = spread(self.first[at], self.many[at])
        rows = []
        for k, (_, h, up, last, before) in enumerate(phrases):
            tail, tctx = (last, np.full(len(h), ANY)) if not k else (
                mix(before * P + last), (follow(before) & ~np.uint64(1) | np.uint64(1 << 63)).view(np.int64))
            rows.append((h.view(np.int64), up.view(np.int64), follow(up).view(np.int64), tail.view(np.int64), tctx,
                         np.full(len(h), k + 2)))
        for h, (up, tail, tctx) in ((self.stems[s], self.more[:, s]), (self.table[at], self.whole[:, at])):
            rows.append((h.view(np.int64), up, up, tail, tctx, np.ones(len(h), np.int64)))
        out = pd.DataFrame({c: np.concatenate(part) for c, part in zip(NODE, zip(*rows))})
        return out[self.marked(out["h"].to_numpy().view(np.uint64))].drop_duplicates("h")

    def letters(self, words: list[str], n1: np.ndarray, n0: np.ndarray) -> pd.DataFrame:
        """(up, h, tail, n1, n0) of the distinct beginnings of the words and of these, with the sums of the words' counts."""
        self.forget()
        self.learn(words)
        h, first, inverse = np.unique(np.concatenate([self.stems, self.table]).view(np.int64),
                                      return_index=True, return_inverse=True)
        out = {"up": np.concatenate([self.more[0], self.whole[0]])[first], "h": h,
               "tail": np.concatenate([self.more[1], self.whole[1]])[first]}
        for c, n in (("n1", n1), ("n0", n0)):
            out[c] = np.bincount(inverse, np.concatenate([np.repeat(n, self.many), n]), len(h)).astype(np.int64)
        return pd.DataFrame(out)

    def classes(self, texts, y: np.ndarray) -> pd.DataFrame:
        """(word, n1, n0): distinct words of a text, over the texts of each class."""
        doc, at = self.tokens(texts)
        single = np.unique(doc * max(len(self), 1) + at)
        doc, at = single // max(len(self), 1), single % max(len(self), 1)
        n = [np.bincount(at[y[doc] == c], minlength=len(self)) for c in (1, 0)]
        here = n[0] + n[1] > 0
        words = np.fromiter(self, object, len(self))[here]
        return pd.DataFrame({"word": words, "n1": n[0][here], "n0": n[1][here]})


class Known:
    """The highest ``TABLE`` rows of a model by ``rank``, and the bits of all lower ones, None if there are none. The
    driver hands the rows on as it gets them, packed; the tasks sort them once."""

    def __init__(self, model: DataFrame | None, rank: str = "h", value: str = "h", kind: str = "double"):
        self.kind, self.rest, self.rows = kind, None, []
        if model is not None:
            many, top = model.count(), model
            if many > TABLE:
                least = model.agg(F.percentile_approx(rank, 1 - TABLE / many)).first()[0]
                top, self.lower = model.where(F.col(rank) > least), model.where(F.col(rank) <= least)
                self.rest = bits_of(self.lower)
            packed = top.select("h", F.col(value).cast(kind).alias("v")).mapInPandas(lambda batches: (
                pd.DataFrame({c: [pdf[c].to_numpy().tobytes()] for c in pdf}) for pdf in batches), "h binary, v binary")
            self.rows = [tuple(r) for r in packed.collect()]

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k != "lower"}

    def __setstate__(self, state):
        vars(self).update(state)
        h = np.frombuffer(b"".join(r[0] for r in self.rows), np.uint64)
        order = np.argsort(h)
        self.keys = h[order]
        self.values = np.frombuffer(b"".join(r[1] for r in self.rows), {"double": np.float64, "int": np.int32}[self.kind])[order]
        self.rows = None
        self.bits = np.zeros(1 << 20, np.uint64)
        b = h & np.uint64((1 << 26) - 1)
        np.bitwise_or.at(self.bits, (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))

    def look(self, h: np.ndarray) -> np.ndarray:
        """The value of each hash, NaN if it is not held."""
        out = np.full(len(h), np.nan)
        at = np.flatnonzero(marked(self.bits, h))
        if len(at):
            to = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            same = self.keys[to] == h[at]
            out[at[same]] = self.values[to[same]]
        return out

    def lower_ones(self, h: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether each hash may be one of the lower rows."""
        return np.zeros(len(h), bool) if self.rest is None else np.isnan(value) & marked(self.rest, h)


class Weigher(Grams):
    """Of each word: ``gain``, the sum of its weights of ``letters``, and ``top``, the largest ratio of its
    expressions in ``model``, as far as these hold them; what may be lower rows of either in ``left`` and ``low``."""

    def __init__(self, model: Known, letters: Known, longest: int):
        self.model, self.letters = model, letters
        root = letters.look(np.full(1, ROOT, np.uint64))
        self.start = np.nan_to_num(root)[0]
        super().__init__(longest=longest)

    def forget(self):
        super().forget()
        self.gain, self.top = np.zeros(0), np.zeros(0)
        self.left, self.low = ((np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) for _ in range(2))

    def learn(self, words: list[str]):
        word, stem, of, long, *_ = self.hashed(words)
        n = len(words)
        x, end = self.letters.look(stem), self.letters.look(word)
        gain = np.bincount(of, np.nan_to_num(x), n) + np.nan_to_num(end) + self.start
        # a beginning is in the model only if all shorter ones are
        over = np.full(n, np.iinfo(np.int64).max)
        held = self.letters.lower_ones(stem, x)
        np.minimum.at(over, of[np.isnan(x) & ~held], long[np.isnan(x) & ~held])
        held &= long < over[of]
        last = self.letters.lower_ones(word, end) & (over == np.iinfo(np.int64).max)
        self.left = self.listed(self.left, n, of[held], stem[held], last, word)
        y, end = self.model.look(stem), self.model.look(word)
        top = np.nan_to_num(end)
        np.maximum.at(top, of, np.nan_to_num(y))
        held = self.model.lower_ones(stem, y)
        self.low = self.listed(self.low, n, of[held], stem[held], self.model.lower_ones(word, end), word)
        self.table = np.concatenate([self.table, word])
        self.gain, self.top = np.concatenate([self.gain, gain]), np.concatenate([self.top, top])

    @staticmethod
    def listed(lists, n: int, of: np.ndarray, stem: np.ndarray, last: np.ndarray, word: np.ndarray):
        """``lists`` (first, many, hashes) with those of ``n`` more words: beginnings ``stem`` of the words ``of``,
        and of the words ``last`` the word itself."""
        first, many, hashes = lists
        of, h = np.concatenate([of, np.flatnonzero(last)]), np.concatenate([stem, word[last]])
        more = np.bincount(of, minlength=n)
        return (np.concatenate([first, len(hashes) + np.cumsum(more) - more]), np.concatenate([many, more]),
                np.concatenate([hashes, h[np.argsort(of, kind="stable")]]))

    def rows(self, k: np.ndarray, anon: np.ndarray, texts) -> pd.DataFrame:
        """``PART`` rows: one of each text with what the tables hold, then one of each lower row it may meet."""
        doc, at = self.tokens(texts)
        w, n = self.table[at], len(k)
        words, total = np.bincount(doc, minlength=n), np.bincount(doc, self.gain[at], n)
        top = np.zeros(n)
        np.maximum.at(top, doc, self.top[at])
        d, h, _ = self.listing(doc, at, self.low)
        low = [(d, h)]
        for size, phrase, _ in self.phrases(doc, w):
            here = doc[:max(len(doc) - size, 0)]
            inside = np.flatnonzero(doc[size:] == here)
            here, phrase = here[inside], phrase[inside]
            value = self.model.look(phrase)
            np.maximum.at(top, here, np.nan_to_num(value))
            may = self.model.lower_ones(phrase, value)
            low.append((here[may], phrase[may]))
        d, h = (np.concatenate(x) for x in zip(*low))
        low = d[top[d] == 0], h[top[d] == 0]  # all rows of the table are higher than these
        parts = [(np.arange(n), k, np.full(n, -2), np.zeros(n, np.int64), np.ones(n, np.int64), words, total, top)]
        for (d, h, times), salt in ((self.listing(doc, at, self.left), -1), (once(*low), None)):
            none = np.zeros(len(d), np.int64)
            parts.append((d, h.view(np.int64), np.full(len(d), salt) if salt else k[d] % SALTS, times, none, none,
                          none.astype(float), none.astype(float)))
        d, h, salt, times, rows, words, total, top = (np.concatenate(x) for x in zip(*parts))
        return pd.DataFrame({"k": k[d], "anon": anon[d], "h": h, "salt": salt, "times": times, "rows": rows, "words": words,
                             "total": total, "top": top})

    @staticmethod
    def listing(doc: np.ndarray, at: np.ndarray, lists):
        """(doc, hash, times) of the hashes listed for the words of each text."""
        first, many, hashes = lists
        here = many[at] > 0
        doc, at = doc[here], at[here]
        return once(np.repeat(doc, many[at]), hashes[spread(first[at], many[at])])


def once(d: np.ndarray, h: np.ndarray):
    """(d, h, times) of the distinct pairs."""
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return d[at], h[at], np.diff(np.append(at, len(d)))


def parts(pdf: pd.DataFrame):
    """Rows of about ``CHARS`` characters at a time, one row at least."""
    at = (pdf["text"].str.len().fillna(0).cumsum() // CHARS).to_numpy()
    for _, part in pdf.groupby(at, sort=False):
        yield part


def bits_of(table: DataFrame) -> np.ndarray:
    """Bit table of the hashes, 256 bits or more for each while it takes at most 8 MB."""
    want = 256 * max(table.count(), 1 << 12)
    return bit_table(table, min(1 << (want - 1).bit_length(), 1 << 26))


def counts(rows: DataFrame, bits: np.ndarray | None = None, longest: int = 2) -> DataFrame:
    """(h, n) of expressions and contexts in all rows; with ``bits``, of those whose bit is set."""
    table = None if bits is None else rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        grams = Grams(None if table is None else table.value, longest=longest)
        for pdf in batches:
            for part in parts(pdf):
                yield grams.tally(part["text"])

    return rows.select("text").mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def expressions(rows: DataFrame, bits: np.ndarray, longest: int = 2) -> DataFrame:
    """``NODE`` rows of the expressions whose bit is set, each once."""
    table = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        grams = Grams(table.value, full=True, longest=longest)
        for pdf in batches:
            for part in parts(pdf):
                yield grams.nodes(part["text"])

    found = rows.select("text").mapInPandas(run, ", ".join(f"{c} long" for c in NODE))
    return found.groupBy("h").agg(*[F.min(c).alias(c) for c in NODE[1:]])


def chained(steps: DataFrame) -> DataFrame:
    """(h, total): sum of ``step`` of rows (h, up, step) along ``up``, null at a chain's start. In every round
    the open rows join the rows they point to, so that jumps double."""
    rows = spilled(steps, "chain")
    for _ in range(64):
        ahead = rows.where("up is not null")
        if ahead.isEmpty():
            break
        to = rows.select(F.col("h").alias("up"), F.col("up").alias("next"), F.col("step").alias("s"))
        rows = spilled(ahead.join(to, "up").select(
            "h", F.col("next").alias("up"), (F.col("step") + F.col("s")).alias("step"))
            .unionByName(rows.where("up is null")), "chain")
    return rows.select("h", F.col("step").alias("total"))


def discounted(k, kinds, total, lower):
    """Kneser-Ney share of a count ``k`` among ``kinds`` followers of ``total`` counts."""
    return (F.greatest(k - DELTA, F.lit(0.0)) + DELTA * kinds * lower) / total


def continuation(tails: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(tail, tctx, q) from counts (tail, tctx, k): each order backs off to the next shorter one. The tail of a third
    word is its pair with the word before, which backs off to the tail of that pair in ``pairs`` (h, tail)."""
    def shares(rows, by):
        return rows.join(rows.groupBy(*by).agg(F.count("*").alias("t"), F.sum("k").alias("m")), by) if by else \
            rows.crossJoin(F.broadcast(rows.agg(F.count("*").alias("t"), F.sum("k").alias("m"))))  # one row

    even = F.lit(1.0) / (F.col("t") + 1)
    q = discounted(F.col("k"), F.col("t"), F.col("m"), F.col("q"))
    words = shares(tails.where(F.col("tctx") == ANY), []).withColumn("q", even).select("tail", "tctx", q.alias("q"))
    third = None if pairs is None else shares(tails.where(F.col("tctx") < ANY), ["tctx"]).join(
        pairs.select(F.col("h").alias("tail"), F.col("tail").alias("last")), "tail").join(
        words.select(F.col("tail").alias("last"), "q"), "last").select("tail", "tctx", q.alias("q"))
    letters = tails.where(F.col("tctx") >= 0).withColumn("x", F.shiftright("tail", 42)).withColumn(
        "prev", F.shiftright("tctx", 21))
    one = letters.groupBy("x", "prev").agg(F.count("*").alias("k"))
    none = shares(one.groupBy("x").agg(F.count("*").alias("k")), []).withColumn("q", even).select("x", q.alias("q"))
    one = shares(one, ["prev"]).join(none, "x").select("x", "prev", q.alias("q"))
    out = shares(letters, ["tctx"]).join(one, ["x", "prev"]).select("tail", "tctx", q.alias("q")).unionByName(words)
    return out if third is None else out.unionByName(third)


def simple_backoff(nodes: DataFrame, tails: DataFrame) -> DataFrame:
    """Nodes with q, the share of the continuation counts alone."""
    letters = nodes.where(F.col("tctx") != ANY)
    words = nodes.where(F.col("tctx") == ANY).withColumn("m", F.lit(nodes.where(F.col("tctx") == ANY).count()))
    return letters.join(letters.groupBy("tctx").agg(F.count("*").alias("m")), "tctx").unionByName(words).join(
        tails, ["tail", "tctx"]).withColumn("q", F.col("k") / (F.col("m") + 1))


def train(labelled: DataFrame, recursive: bool = False, longest: int = 2, floor: float = FLOOR) -> DataFrame:
    """(h, llr) of the expressions that speak for toxic, from rows (text, y); exact counts. Phrases have at
    most ``longest`` words, two or three; ratios below ``floor`` are left out."""
    toxic = labelled.where("y = 1")
    seen = spilled(counts(toxic, longest=longest).where(F.col("n") > D).withColumnRenamed("n", "n1"), "seen")
    bits = bits_of(seen)
    both = spilled(seen.join(counts(labelled.where("y = 0"), bits, longest).withColumnRenamed("n", "n0"), "h", "left")
                       .fillna(0, ["n0"]), "counts")
    nodes = spilled(expressions(toxic, bits, longest).join(both, "h"), "nodes")
    # the shared backoff: distinct contexts of a continuation, among all that follow the same letters or any word
    tails = nodes.groupBy("tail", "tctx").agg(F.count("*").alias("k"))
    if recursive:
        pairs = nodes.where(F.col("tctx") == ANY) if longest > 2 else None
        nodes = nodes.join(continuation(spilled(tails, "tails"), pairs), ["tail", "tctx"])
    else:
        nodes = simple_backoff(nodes, tails)
    # what follows a context, rarer followers as one symbol
    ctx = nodes.groupBy("ctx").agg(F.count("*").alias("t1"), F.sum((F.col("n0") > 0).cast("long")).alias("t0"),
                                   F.sum("n1").alias("s1"), F.sum("n0").alias("s0")).join(
        both.select(F.col("h").alias("ctx"), F.col("n1").alias("c1"), F.col("n0").alias("c0")), "ctx")

    def likely(c):
        n, t, s, all_ = (F.col(f"{x}{c}") for x in "ntsc")
        kinds = t + (all_ > s).cast("long")
        return F.log((F.greatest(n - D, F.lit(0.0)) + (THETA + D * kinds) * F.col("q")) / (all_ + THETA))

    steps = spilled(nodes.join(ctx, "ctx").select(
        "h", F.when(F.col("up") != ROOT, F.col("up")).alias("up"), "words", (likely(1) - likely(0)).alias("step")), "steps")
    ratio = spilled(chained(steps.select("h", "up", "step")).join(steps.select("h", "up", "words"), "h").select(
        "h", "up", (F.col("total") / F.col("words")).alias("llr")), "ratio")
    # an expression that is no more toxic than what it continues never has the maximum alone
    ahead = ratio.where(F.col("llr") >= floor)
    return spilled(ahead.join(ahead.select(F.col("h").alias("up"), F.col("llr").alias("before")), "up", "left").where(
        "before is null or llr > before").select("h", "llr"), "model")


def letter_weights(labelled: DataFrame) -> DataFrame:
    """(h, v, rank) of the letter models of both classes: the log ratio of a word is the sum of the weights of ``ROOT``,
    its beginnings and itself, in units of ``UNIT``, as far as they have one.

    All letters that follow a beginning in any labelled text count, so that the discounted shares and the backoff's of
    a context add up to one. What neither class has more than ``D`` times is discounted to nothing in both, and
    as the backoff is shared, its ratio is that of a letter never seen there, the ratio of the backoff's masses (the
    context's ``gap``); the weight of a row is its ratio less the gap before it, plus its own gap, and needs no row where
    these cancel. A higher ``rank`` is a more frequent row."""
    def count(batches):
        grams = Grams(np.zeros(1, np.uint64))  # the words alone
        for pdf in batches:
            for part in parts(pdf):
                yield grams.classes(part["text"], part["y"].to_numpy())

    def split(batches):
        grams = Grams(full=True)
        for pdf in batches:
            at = (pdf["word"].str.len().cumsum() // CHARS).to_numpy()
            for _, part in pdf.groupby(at, sort=False):
                yield grams.letters(list(part["word"]), part["n1"].to_numpy(), part["n0"].to_numpy())

    words = labelled.where("y in (0, 1)").select("text", "y").mapInPandas(count, "word string, n1 long, n0 long")
    words = words.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    # words with a common beginning stand together, so that few beginnings are met twice
    found = words.sortWithinPartitions("word").mapInPandas(split, "up long, h long, tail long, n1 long, n0 long")
    nodes = found.repartition("up").groupBy("up", "h").agg(
        F.min("tail").alias("tail"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    by, more = Window.partitionBy("up"), lambda c: F.greatest(F.col(f"n{c}") - D, F.lit(0.0))
    held = (F.col("n1") > D) | (F.col("n0") > D)
    for c in (1, 0):
        nodes = nodes.withColumn(f"s{c}", F.sum(f"n{c}").over(by)).withColumn(f"r{c}", F.sum(more(c)).over(by))
    # one of its rows brings the gap of a context
    nodes = nodes.withColumn("up", F.when(F.min(F.when(held, F.col("h"))).over(by) == F.col("h"), F.col("up")))
    tctx = F.col("tail").bitwiseAND((1 << 42) - 1).alias("tctx")
    nodes = spilled(nodes.select("tail", *[F.when(held, F.col(c)).alias(c) for c in nodes.columns if c != "tail"]), "letters")
    q = continuation(spilled(nodes.groupBy("tail", tctx).agg(F.count("*").alias("k")), "tails"))
    rows = nodes.where("h is not null").select("*", tctx).join(q, ["tail", "tctx"])

    def mass(c):
        return F.lit(THETA) + F.col(f"s{c}") - F.col(f"r{c}")

    def likely(c):
        return F.log((more(c) + mass(c) * F.col("q")) / (F.col(f"s{c}") + THETA))

    def units(x):
        return F.round(x * UNIT).cast("long").alias("v")

    gap = F.log(mass(1) / (F.col("s1") + THETA)) - F.log(mass(0) / (F.col("s0") + THETA))
    rows = rows.select(F.explode(F.array(
        F.struct("h", units(likely(1) - likely(0) - gap), (F.col("n1") + F.col("n0")).alias("n")),
        F.struct(F.col("up").alias("h"), units(gap), (F.col("s1") + F.col("s0")).alias("n")))).alias("r")).select("r.*")
    # the hash keeps rows of equal count apart
    rank = F.max("n") + F.pmod("h", F.lit(1 << 20)) / (1 << 20)
    return spilled(rows.where("h is not null").groupBy("h").agg(F.sum("v").alias("v"), rank.alias("rank")), "weights")


def measures(docs: DataFrame, model: DataFrame, letters: DataFrame | None = None, longest: int = 2) -> DataFrame:
    """(doc_id, rows, words, mean, top) of the rows of each doc_id, or of each text without one: how many they are, their
    words, the mean log ratio of these in ``letters``, the largest ratio of their expressions in ``model``. Both
    models' highest rows go to the tasks, ``TABLE`` at most; what may meet lower ones is joined with these."""
    best, common = Known(model, "llr", "llr"), Known(letters, "rank", "v", "int")
    table = docs.sparkSession.sparkContext.broadcast((best, common))

    def run(batches):
        weigher = Weigher(*table.value, longest)
        for pdf in batches:
            for part in parts(pdf):
                yield weigher.rows(part["k"].to_numpy(np.int64), part["anon"].to_numpy(bool), part["text"])

    # rows without a key are told apart by their texts
    anon, text = F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit("")))
    out = docs.select(F.coalesce(F.col("doc_id").cast("long"), text).alias("k"), anon.alias("anon"), "text").mapInPandas(run, PART)
    lower = [m.lower.select("h", salt.alias("salt"), F.col(value).cast("double").alias("value")) for m, salt, value in (
        (best, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))), "llr"), (common, F.lit(-1), "v")) if m.rest is not None]
    if lower:
        value = F.coalesce("value", F.lit(0.0))
        # ``SALTS`` times the rows that the size of the model's files tells: never broadcast
        out = out.join(reduce(DataFrame.unionByName, lower).hint("shuffle_merge"), ["h", "salt"], "left").withColumn(
            "total", F.col("total") + F.col("times") * F.when(F.col("salt") == -1, value).otherwise(0.0)).withColumn(
            "top", F.greatest("top", F.when(F.col("salt") >= 0, value).otherwise(0.0)))
    return out.groupBy("k", "anon").agg(F.sum("rows").alias("rows"), F.sum("words").alias("words"),
                                        F.sum("total").alias("total"), F.max("top").alias("top")).select(
        F.when(~F.col("anon"), F.col("k")).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "rows", "words",
        F.when(F.col("words") > 0, F.col("total") / F.col("words") / UNIT).alias("mean"), "top")


def statistics(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, stat) of the documents that hold an expression of the model."""
    return measures(docs, model).where("doc_id is not null and top > 0").select("doc_id", F.col("top").alias("stat"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    lab = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # one plan at every size: labels grow with the documents, so they are never broadcast
    seen = spilled(docs.where(fold.isin(0, 1)).select("doc_id", "text").join(
        lab.where("toxic is not null").hint("shuffle_merge"), "doc_id").select("text", F.col("toxic").alias("y")), "labelled")
    found = measures(docs, train(seen, recursive=True, longest=3, floor=0.0), letter_weights(seen), longest=3)
    stats = spilled(found.join(lab, "doc_id", "left").select(
        "doc_id", "toxic", fold.alias("fold"), "rows", "top", "mean"), "stats")
    cells = stats.where("fold = 3 and toxic is not null").groupBy(
        (F.round(F.col("top") * 20) / 20).alias("top"), (F.round(F.col("mean") * 50) / 50).alias("mean"), "toxic").agg(
        F.sum("rows").alias("n")).toPandas()
    # without both classes there is nothing to compare: the score is the share of toxic labels, held below the
    # threshold, for expressions below ``FLOOR``, and rises with evidence if the other folds gave any
    total = cells["n"].sum()
    prior = float((cells["n"] * cells["toxic"]).sum() / total) if total else 0.0
    prior = min(max(prior, 0.01), 0.25)
    logit, usual = F.lit(float(np.log(prior / (1 - prior)))) + F.when(F.col("top") >= FLOOR, F.col("top")).otherwise(0.0), 0.0
    if cells["toxic"].nunique() == 2:
        n, yy = cells["n"].to_numpy(float), cells["toxic"].to_numpy(float)
        worded = cells["mean"].notna() & (cells["toxic"] == 0)
        usual = float(np.average(cells["mean"][worded], weights=n[worded])) if worded.any() else 0.0
        x = np.stack([cells["top"].to_numpy(float), cells["mean"].fillna(usual).to_numpy(float)])
        mu = np.average(x, axis=1, weights=n)
        sd = np.sqrt(np.average((x - mu[:, None]) ** 2, axis=1, weights=n)) + 1e-9
        x = (x - mu[:, None]) / sd[:, None]

        def fit(z, at, ridge):
            th = np.zeros(len(z))
            for _ in range(50):
                p = 1 / (1 + np.exp(-at - th @ z))
                th += np.linalg.solve((z * (n * p * (1 - p))) @ z.T + ridge * np.eye(len(z)), (z * n) @ (yy - p) - ridge * th)
            return th

        # the mean speaks for what the expressions leave open: words of neither class raise it in any text
        first = np.stack([np.ones_like(n), x[0]])
        th = fit(first, 0.0, 0.1)
        th = np.append(th, fit(x[1:], th @ first, 1.0))
        b = th[1:] / sd
        logit = F.lit(float(th[0] - b @ mu)) + F.lit(float(b[0])) * F.col("top") + F.lit(float(b[1])) * F.coalesce("mean", F.lit(usual))
    return stats.select("doc_id", F.coalesce(F.col("fold") == 2, F.lit(False)).alias("held_out"),
                        (1 / (1 + F.exp(-logit))).alias("score"), F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row")
                        ).withColumn("predicted", (F.col("score") >= 0.3).cast("int")).drop("row")
