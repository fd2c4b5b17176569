"""MinHash near-duplicates with tensored banding (operator 9).

``m`` left and ``m`` right collections of ``r`` minhashes are combined in
pairs into m*m table keys, so 2*m*r minhashes serve m*m tables. Equal shingle
sets are one class with one representative; only keys that two representatives share
make table rows.

Links are confirmed on full sets, in tasks of bounded groups:

1. Stars. The member of a table whose keys are shared most is its centre (of a family
   of edited copies that is the least edited one). Each (centre, member) is compared
   once; a centre's members are salted over tasks of about ``STAR`` texts.
2. Components over the confirmed links.
3. Rest. A member of a star that is not in its centre's component may still link with another
   member, so it is asked in every such star: any two texts that share a table are in one
   component or compared. A member differs from its centre in the set D of the shingles that only one
   of them has, and two members differ in the shingles that only one D has. A link leaves two members
   at most H = (1 - t) / (1 + t) * (n_u + n_x) apart (t the similarity, n the set sizes), and a
   member without a link to the centre is farther than that from it, so that the two D have at least
   (D_u + D_x - H) / 2 > 0 shingles in common. With each D sorted by how many members of the star
   hold a shingle, the rarest first, the first common one stands early enough in both to leave
   room for that many; only members that meet so (``meetings``) are compared, on full sets. Rows grow with the shingles
   of the D, not with the pairs of a star.

Null or wordless texts have no shingles and stay alone; rows of one doc_id
are one document (the row with the smallest set fingerprint counts); an empty table
gives no rows; a null doc_id is a document of its own value; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import cut_lineage, ensure_checkpoint_dir

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
STAR = 1000
BLOCK = 4096


def spilled(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


class Shingler:
    """Sorted distinct 64-bit shingle hashes; word hashes are remembered, at most ``keep`` of them."""

    def __init__(self, words: int, keep: int = 200_000):
        self.words, self.keep, self.known = words, keep, {}

    def __call__(self, text: str | None) -> np.ndarray:
        w = WORD.findall((text or "").translate(UPPER))
        if not w:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for x in set(w).difference(known):
            known[x] = xxhash.xxh3_64_intdigest(x)
        h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
        k = min(self.words, len(w))
        n = len(w) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def shingles(text: str | None, words: int) -> np.ndarray:
    return Shingler(words)(text)


def signatures(docs: DataFrame, words: int, m: int, r: int) -> DataFrame:
    """doc_id, n_shingles, fp (fingerprint of the set), keys (one per collection)."""
    rng = np.random.default_rng(7)
    mult = rng.integers(1, 1 << 63, 2 * m * r, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        shingle = Shingler(words)
        for batch in batches:
            size, fps, keys = [], [], []
            for raw in batch.column(1).to_pylist():
                s = shingle((raw or b"").decode("utf-8", "replace"))
                size.append(len(s))
                fps.append(xxhash.xxh3_128_digest(s.tobytes()))
                if not len(s):
                    keys.append([])
                    continue
                mins = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
                for low in range(0, len(s), 4096):
                    p = s[None, low:low + 4096] * mult[:, None]
                    p ^= p >> np.uint64(31)
                    np.minimum(mins, p.min(axis=1), out=mins)
                keys.append([xxhash.xxh64_intdigest(mins[i * r:i * r + r].tobytes(), i) - (1 << 63)
                             for i in range(2 * m)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(fps, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "fp", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, fp binary, keys array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable over edges (a, b); lineage is cut each round."""
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    lab = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        near = both.join(lab, both.b == lab.id).groupBy("a").agg(F.min("label").alias("low"))
        new = lab.join(near, lab.id == near.a, "left").select(
            "id", F.least("label", F.coalesce("low", "label")).alias("label"), F.col("label").alias("was"))
        jump = new.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = cut_lineage(new.join(jump, "label", "left").select(
            "id", F.least("label", F.coalesce("far", "label")).alias("label"), "was"))
        if not new.where("label <> was").take(1):
            return new.select("id", "label")
        lab = new.select("id", "label")


def star_pairs(reps: DataFrame, m: int) -> DataFrame:
    """Distinct (a, id): each table's member and its centre."""
    keyed = reps.select("id", F.posexplode("keys").alias("pos", "key"))
    shared = keyed.groupBy("pos", "key").agg(F.count("*").alias("n")).where("n > 1")
    hit = keyed.join(shared, ["pos", "key"]).groupBy("id").agg(
        F.collect_list(F.struct("pos", "key")).alias("h"), F.sum("n").alias("pop"))
    left, right = F.filter("h", lambda x: x.pos < m), F.filter("h", lambda x: x.pos >= m)
    table = hit.select("id", "pop", F.explode(F.flatten(F.transform(left, lambda a: F.transform(
        right, lambda b: F.xxhash64(a.pos, a.key, b.pos, b.key))))).alias("t"))
    star = table.groupBy("t").agg(F.max(F.struct("pop", (-F.col("id")).alias("neg"))).alias("c"),
                                  F.count("*").alias("n")).where("n > 1")
    return table.select("id", "t").join(star, "t").select((-F.col("c.neg")).alias("a"), "id").where(
        "id <> a").distinct()


def compared(rows: DataFrame, words: int, differ: bool = False) -> DataFrame:
    """(a, id, n_a, n, both) for ``rows`` (a, salt, id, text, first), sorted so that each (a, salt)
    begins with its centre's text. If ``differ``, (a, id, d), the shingles that only one of both has."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())] if differ else [pa.int64()] * 5
    names = ["a", "id", "d"] if differ else ["a", "id", "n_a", "n", "both"]

    def run(batches):
        shingle = Shingler(words)
        at, centre = None, None
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("a", "salt", "id", "first", "text")]
            for a, salt, i, first, text in zip(*cols):
                s = shingle(text)
                if first:
                    at, centre = (a, salt), s
                elif at == (a, salt) and differ:
                    out.append((a, i, np.setxor1d(centre, s, assume_unique=True).view(np.int64)))
                elif at == (a, salt):
                    out.append((a, i, len(centre), len(s), len(np.intersect1d(centre, s, assume_unique=True))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[j] for o in out], k) for j, k in enumerate(kinds)], names=names)

    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.desc("first"))
    return dealt.select("a", "salt", "id", "first", "text").mapInArrow(
        run, "a long, id long, d array<long>" if differ else "a long, id long, n_a long, n long, both long")


def compare_stars(pairs: DataFrame, texts: DataFrame, words: int, differ: bool = False) -> DataFrame:
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("salts"))
    members = pairs.join(texts, "id").join(salts, "a").select(
        "a", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "id", "text", F.lit(False).alias("first"))
    centres = salts.withColumnRenamed("a", "id").join(texts, "id").select(
        F.col("id").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        "id", "text", F.lit(True).alias("first"))
    return compared(members.unionByName(centres), words, differ)


def linked_pairs(compared_rows: DataFrame, num: int, den: int) -> DataFrame:
    return compared_rows.where(den * F.col("both") >= num * (F.col("n") + F.col("n_a") - F.col("both"))).select(
        "a", F.col("id").alias("b"))


def meetings(one: DataFrame, apart: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct (a, id), the smaller id first: star members of two components, one of them ``foreign``,
    that can link. ``one`` has (a, id, n_a, n, both, label, foreign), ``apart`` their (a, id, d)."""
    h = (den - num) / (den + num)
    held = apart.select("a", "id", F.explode("d").alias("token")).withColumn(
        "held", F.count("*").over(Window.partitionBy("a", "token"))).where("held > 1")
    # shingles held once meet nobody, but stand first
    size = F.col("n_a") + F.col("n") - 2 * F.col("both")
    lists = held.groupBy("a", "id").agg(F.array_sort(F.collect_list(F.struct("held", "token"))).alias("o")).join(
        one, ["a", "id"]).withColumn("size", size)
    # last ranks that leave room for the least overlap: with any foreign member, and of a foreign one with any
    meets = F.col("size") - F.greatest(F.lit(1), F.ceil((F.col("size") + h * (F.col("n_a") - F.col("n"))) / 2 - 1e-6))
    asks = F.when(F.col("foreign"), F.col("size") - F.greatest(
        F.lit(1), F.ceil(F.col("size") - F.col("n") * ((den - num) / num) - 1e-6))).otherwise(-1)
    lists = lists.withColumn("meets", meets).withColumn("asks", asks).withColumn("alone", F.col("size") - F.size("o"))
    room = F.greatest(F.lit(0), F.greatest("meets", "asks") + 1 - F.col("alone")).cast("int")
    ranked = spilled(lists.select(
        "a", "id", "n", "both", "label", "size", "meets", "asks", "alone",
        F.posexplode(F.slice("o", 1, room)).alias("pos", "x")).select(
        "*", "x.*", (F.col("alone") + F.col("pos")).alias("rank")).drop("x", "pos", "alone"), "ranked")
    parts = F.ceil(F.col("held") / BLOCK).cast("int")
    u = ranked.where("rank <= asks").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).alias("u")
    x = ranked.where("rank <= meets").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).alias("x")
    both = lambda c: (F.col(f"u.{c}"), F.col(f"x.{c}"))
    (n, m), (du, dx), (i, j), (inu, inx) = map(both, ("n", "size", "rank", "both"))
    far = h * (n + m) + 1e-6
    shared = (du + dx - far) / 2
    can = ((F.col("u.label") != F.col("x.label")) & (F.abs(du - dx) <= far) & (i + shared <= du) & (j + shared <= dx)
           & ((F.least(inu, inx) + F.least(n - inu, m - inx)) * (den + num) >= num * (n + m)))
    return u.join(x, [F.col(f"u.{c}") == F.col(f"x.{c}") for c in ("a", "token", "part")] + [can]).select(
        F.least("u.id", "x.id").alias("a"), F.greatest("u.id", "x.id").alias("id")).distinct()


def rest_links(stars: DataFrame, labels: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) across components within a star: a member is asked in each star whose centre lies in
    another component than its own."""
    lab = labels.withColumnRenamed("id", "a").withColumnRenamed("label", "centre_label")
    one = stars.join(labels, "id", "left").join(lab, "a", "left").select(
        "a", "id", "n_a", "n", "both", F.coalesce("label", "id").alias("label"),
        F.coalesce("centre_label", "a").alias("of")).withColumn("foreign", F.col("label") != F.col("of"))
    some = one.groupBy("a").agg(F.count("*").alias("members"), F.max("foreign").alias("any")).where("members > 1 and any")
    one = spilled(one.join(some.select("a"), "a"), "stars")
    apart = compare_stars(one.select("a", "id"), texts, words, differ=True)
    near = spilled(meetings(one, apart, num, den), "meetings")
    return linked_pairs(compare_stars(near, texts, words), num, den)


def wanted_texts(docs: DataFrame, asked: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(id, text) of the ids in ``asked``. Of the rows of one id a text whose shingle set is
    the representative's; texts of one set compare alike."""

    def run(batches):
        shingle = Shingler(words)
        for batch in batches:
            fps = [xxhash.xxh3_128_digest(shingle(x).tobytes()) for x in batch.column("text").to_pylist()]
            keep = pa.array([f == g for f, g in zip(fps, batch.column("fp").to_pylist())], pa.bool_())
            yield batch.select(["id", "text"]).filter(keep)

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    twice = rows.groupBy("id").agg((F.count("*") > 1).alias("twice")).where("twice")
    found = spilled(rows.join(asked.join(twice, "id", "left"), "id"), "texts")
    several = found.where("twice").join(reps.select("id", "fp"), "id").select("id", "text", "fp")
    picked = several.mapInArrow(run, "id long, text string").groupBy("id").agg(F.min("text").alias("text"))
    return found.where("twice is null").select("id", "text").unionByName(picked)


def groups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
           m: int = 11, r: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    sig = signatures(docs, words, m, r).groupBy("doc_id").agg(
        F.min(F.struct("fp", "n_shingles", "keys")).alias("s")).select("doc_id", "s.*")
    sig = spilled(sig, "signatures")
    reps = sig.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"))
    reps = spilled(reps, "representatives")
    pairs = spilled(star_pairs(reps.where("id is not null"), m), "pairs")
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("id")).distinct()
    texts = wanted_texts(docs, asked, reps, words)
    stars = spilled(compare_stars(pairs, texts, words), "compared")
    links = linked_pairs(stars, num, den)
    more = spilled(rest_links(stars, components(links), texts, words, num, den), "rest")
    linked = components(links.unionByName(more))
    cls = reps.select("fp", "id")
    return (sig.where("n_shingles > 0").join(cls, "fp", "left").join(linked, "id", "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "id", "doc_id").alias("component_id"))
            .unionByName(sig.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
