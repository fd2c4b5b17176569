"""Personal data by candidate gradient boosting (operator 2).

Pattern generators propose spans; formats that validate are base spans. A
loose digit-run generator proposes overlapping ones; boosted trees over
cells of format and context features, trained on validated and failing
candidates, select further ``number`` spans at a calibrated threshold.
DataFrame functions and JVM trees only. Null texts are empty ones.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

#: Pattern of each kind.
PATTERNS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?+[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
LOOSE = ("number", r"(?<![0-9])[0-9][0-9\x20().-]{6,24}[0-9](?![0-9])")
FEATURES = ("digits", "marks", "before", "after")


def _digits(s):
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(d):
    n = F.length(d)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 0, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
        (F.substring(d, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substring(d, i, F.lit(1)).cast("int") / 5).cast("int"))) % 10 == 0


def valid(kind: str, s):
    n = F.length(_digits(s))
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & F.coalesce(_luhn(_digits(s)), F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


CHUNK = 256


def _once(value, f):
    """f(value), with ``value`` evaluated once however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def _chunks(a, item):
    """item(slice) of every CHUNK elements of an array; none of an empty one."""
    return F.when(F.size(a) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")),
        lambda c: item(F.slice(a, c * CHUNK + 1, F.lit(CHUNK))))).otherwise(F.array())


def _total(a):
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def matches(text, kind: str, pattern: str):
    """array<struct<s, order, kind, e, ok, txt, before, after>> of all candidates, in order.

    The regular expression runs twice on a text, whatever it finds. Starts are sums of the lengths
    before, taken over sums of CHUNK lengths each; neighbours come from the text between matches."""
    order = [k for k, _ in (*PATTERNS, LOOSE)].index(kind)
    both = F.struct(F.split(text, pattern, -1).alias("pieces"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def placed(x):
        sizes = F.zip_with(F.slice(x.pieces, F.lit(1), F.size(x.found)), x.found, lambda p, m: F.length(p) + F.length(m))
        held = F.struct(x.pieces.alias("pieces"), x.found.alias("found"), sizes.alias("sizes"),
                        _chunks(sizes, _total).cast("array<int>").alias("sums"))
        return _once(held, lambda h: F.transform(h.found, lambda m, i: one(h, m, i)))

    def one(h, m, i):
        c = F.floor(i / CHUNK).cast("int")
        left, right = F.get(h.pieces, i), F.get(h.pieces, i + 1)
        start = _total(F.slice(h.sums, F.lit(1), c)) + _total(F.slice(h.sizes, c * CHUNK + 1, i - c * CHUNK)) + F.length(left)
        return F.struct(start.alias("s"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
                        (start + F.length(m)).alias("e"), valid(kind, m).alias("ok"), m.alias("txt"),
                        F.when(left == "", 3).otherwise(around(F.right(left, F.lit(1)))).alias("before"),
                        around(F.left(right, F.lit(1))).alias("after"))

    return _once(both, placed)


def around(c):
    """Class of a neighbouring character."""
    return F.when(c.rlike("[A-Za-z]"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"\s"), 3).otherwise(0)


def shape(m):
    """Format features of a loose candidate."""
    return [F.length(_digits(m)).alias("digits"),
            F.least(F.length(F.regexp_replace(m, r"[0-9]", "")), F.lit(9)).alias("marks")]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (valid spans), loose (cells of features of the loose candidates)."""
    text = F.coalesce("text", F.lit(""))
    valid_ones = F.array_sort(F.concat(*[F.filter(matches(text, k, p), lambda x: x.ok) for k, p in PATTERNS]))

    def marked(h):
        # base spans by CHUNK with the range that each chunk covers: a candidate looks into few chunks
        chunks = _chunks(h.base, lambda some: F.struct(
            F.array_min(F.transform(some, lambda b: b.s)).alias("s"), F.array_max(F.transform(some, lambda b: b.e)).alias("e"),
            some.alias("some")))

        def cell(c, x):
            meets = lambda b: (b.s < x.e) & (x.s < b.e)
            return F.struct(x.s.alias("s"), x.e.alias("e"), *shape(x.txt), x.before.alias("before"), x.after.alias("after"),
                            F.exists(c, lambda k: meets(k) & F.exists(k.some, meets)).alias("hit"))

        return F.when(F.size(h.base) > 0, _once(chunks, lambda c: F.transform(h.loose, lambda x: cell(c, x)))).otherwise(
            F.transform(h.loose, lambda x: F.struct(
                x.s.alias("s"), x.e.alias("e"), *shape(x.txt), x.before.alias("before"), x.after.alias("after"),
                F.lit(False).alias("hit"))))

    held = F.struct(valid_ones.alias("base"), matches(text, *LOOSE).alias("loose"))
    return docs.select("doc_id", _once(held, lambda h: F.struct(h.base.alias("base"), marked(h).alias("loose"))).alias("h")).select(
        "doc_id", "h.base", "h.loose")


def choose(rows: DataFrame, precision: float = 0.9) -> list[tuple]:
    """Cells of features that the boosted trees select at ``precision``."""
    cells = rows.select(F.explode("loose").alias("c")).groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES],
        F.col("c.hit").cast("double").alias("label")).agg(F.count("*").cast("double").alias("w")).coalesce(1).cache()
    chosen = []
    if cells.select("label").distinct().count() == 2:
        data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(cells)
        model = GBTClassifier(weightCol="w", maxIter=10, maxDepth=3, seed=7).fit(data)
        got = sorted(model.transform(data).select(*FEATURES, "label", "w",
                     vector_to_array("probability")[1].alias("p")).collect(), key=lambda r: -r.p)
        good = seen = 0.0
        for i, r in enumerate(got):
            good, seen = good + r.w * r.label, seen + r.w
            if good >= precision * seen:
                chosen = sorted({tuple(x[f] for f in FEATURES) for x in got[:i + 1]})
    cells.unpersist()
    return chosen


def named(chosen: list[tuple]):
    return F.array(*[F.lit("-".join(map(str, c))) for c in chosen])


def _replaced(text, pattern: str, put):
    """``text`` with each match m between the pieces i and i + 1 as put(pieces, m, i)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _once(F.split(text, pattern, -1), lambda pieces: F.array_join(F.zip_with(
        pieces, F.transform(found, lambda m, i: put(pieces, m, i)),
        lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), ""))


def redact(text, chosen: list[tuple] = ()):
    """The text with its base spans replaced by <KIND>, email first, then the
    loose candidates of ``chosen`` cells by <NUMBER>."""
    for kind, pattern in PATTERNS:
        put = lambda pieces, m, i, kind=kind: F.when(valid(kind, m), f"<{kind.upper()}>").otherwise(m)
        text = _once(text, lambda t: _replaced(t, pattern, put))  # noqa: B023
    if not chosen:
        return text
    kind, pattern = LOOSE

    def mask(pieces, m, i):
        left, right = F.get(pieces, i), F.get(pieces, i + 1)
        before = F.when(left == "", 3).otherwise(around(F.right(left, F.lit(1))))
        name = F.concat_ws("-", *shape(m), before, around(F.left(right, F.lit(1))))
        return F.when(F.array_contains(named(chosen), name), f"<{kind.upper()}>").otherwise(m)

    return _once(text, lambda t: _replaced(t, pattern, mask))


def scan(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """doc_id, counts, base_sha256, spans (code points, end exclusive)."""
    rows = candidates(docs)
    chosen = choose(rows, precision)
    if chosen:
        pick = lambda x: ~x.hit & F.array_contains(named(chosen), F.concat_ws("-", *[x[f] for f in FEATURES]))
        more = F.transform(F.filter("loose", pick), lambda x: F.struct(x.s, F.lit(4), F.lit("number"), x.e))
    else:
        more = F.expr("cast(array() as array<struct<s:int,o:int,k:string,e:int>>)")
    base = F.transform("base", lambda x: F.struct(x.s.alias("s"), x.order.alias("o"), x.kind.alias("k"), x.e.alias("e")))
    say = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x.k, x.s, x.e)), ",")
    more = more.cast("array<struct<s:int,o:int,k:string,e:int>>")
    base = base.cast("array<struct<s:int,o:int,k:string,e:int>>")
    return rows.select("doc_id", *[F.size(F.filter("base", lambda x: x.kind == k)).cast("long").alias(f"n_{k}") for k, _ in PATTERNS],  # noqa: B023
                       F.sha2(say(base), 256).alias("base_sha256"), say(F.array_sort(F.concat(base, more))).alias("spans"))
