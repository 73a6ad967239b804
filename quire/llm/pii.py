"""Personal data by candidate gradient boosting, in DataFrame functions only.

Fixed patterns with checks give the base spans. High-recall generators propose
further, overlapping spans: obfuscated addresses, longer or shorter numbers,
other separators. Each proposal is described by its format and context in a few
small integers. Boosted trees of depth two are grown over counts of equal
descriptions (so the work after one pass over the texts has a fixed bound):
proposals that are base spans are positive, those that fail their check negative,
the rest negative with a low weight. On a held-out fifth the lowest score per
kind that reaches the wanted precision is its threshold; a proposal above it is
added if it meets no base span and no better proposal.

Positions come from splitting at a pattern: the lengths of the pieces between
matches and of the matches. Patterns are possessive and start at the first
character a match can start at (or where the last match ended), which leaves
the leftmost matches as they are and takes time in proportion to the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High-recall generators; cheap tests tell which texts can hold a match.
PROPOSE = {
    "email": (rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*+",),
    "ip": (r"(?:(?<![0-9.])|\G)[0-9]++(?:\.[0-9]++){2,}+|(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}",),
    "card": (
        r"(?:(?<![0-9])|\G)[0-9](?:[\x20./-]?[0-9]){11,18}+",
        r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20./-][0-9]{4}){2}[\x20./-][0-9]{1,4})(?![0-9])",
    ),
    "phone": (
        r"(?:(?<![0-9])|\G)\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}+",
        r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
    ),
}
MAY_HOLD = {
    "email": r"@|\(at\)|\[at\]",
    "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]",
    "card": r"[0-9](?:[\x20./-]?[0-9]){11}",
    "phone": r"\+[0-9]|[0-9](?:[\x20().-]{0,2}[0-9]){6}",
}
CONTEXT = (
    r"(?i)(?:tel|phone|call|fax|mobil|cell)[^\n]{0,12}$",
    r"(?i)(?:mail|contact|write|reach)[^\n]{0,12}$",
    r"(?i)(?:card|visa|account|iban|pay)[^\n]{0,12}$",
    r"(?i)(?:\bip|host|server|addr|node)[^\n]{0,12}$",
    r"(?i)(?:version|\bv|license|no|date|token|id)[^\n]{0,4}$",
)
FEATURES = 11
TREES, RATE, UNLABELLED, PRECISION = 10, 0.4, 0.3, 0.9
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once a row (what a function of
    array elements names from outside is computed anew for each element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(values: Column, merge) -> Column:
    """Running results of an associative ``merge`` over array<int>, by doubling
    distances: n log n steps, and no array that is copied for every element.
    ``merge`` gets null where there is nothing before."""

    def step(acc: Column, j: Column) -> Column:
        moved = F.concat(F.array_repeat(F.lit(None).cast("int"), F.pow(F.lit(2), j).cast("int")), acc)
        return F.slice(F.zip_with(acc, moved, lambda x, y: merge(x, y).cast("int")), F.lit(1), F.size(acc))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    return F.aggregate(rounds, values, step)


def _hits(text: Column, pattern: str, may_hold: str) -> Column:
    """array<(m, s, before, after)>: matches with their start in code points
    and up to 24 code points around them. The pattern only runs over a text in
    which the cheap test finds something."""

    def place(pieces: Column, found: Column) -> Column:
        n = F.size(found)
        left, right = F.slice(pieces, F.lit(1), n), F.slice(pieces, F.lit(2), n)
        ends = _let(F.zip_with(left, found, lambda p, m: (F.length(p) + F.length(m)).cast("int")), lambda v: _scan(v, lambda x, y: x + F.coalesce(y, F.lit(0))))
        hits = F.zip_with(found, ends, lambda m, e: F.struct(m.alias("m"), (e - F.length(m)).cast("int").alias("s")))
        around = F.zip_with(left, right, lambda p, q: F.struct(F.substr(p, F.lit(-24)).alias("before"), F.left(q, F.lit(24)).alias("after")))
        return F.zip_with(hits, around, lambda h, c: F.struct(h["m"].alias("m"), h["s"].alias("s"), c["before"].alias("before"), c["after"].alias("after")))

    run = F.rlike(text, F.lit(may_hold))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    got = _let(F.split(text, pattern, -1), lambda pieces: _let(found, lambda m: place(pieces, m)))
    return F.when(run, got).otherwise(F.array().cast("array<struct<m:string,s:int,before:string,after:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Luhn check of a string of digits (19 at most)."""
    figures = F.transform(F.filter(F.split(F.reverse(d), ""), lambda c: c != ""), lambda c, i: F.struct(c.cast("int").alias("c"), (i % 2).alias("odd")))
    total = F.aggregate(
        figures, F.lit(0),
        lambda acc, x: (acc + F.when(x["odd"] == 0, x["c"]).when(x["c"] > 4, 2 * x["c"] - 9).otherwise(2 * x["c"])).cast("int"),
    )
    return total % 10 == 0


def checked(kind: str, m: Column) -> Column:
    """Whether a match of the kind's base pattern passes its check."""
    d = _digits(m)
    if kind == "ip":

        def small(x: Column) -> Column:
            y = F.regexp_replace(x, "^0+", "")
            return (F.length(y) < 3) | ((F.length(y) == 3) & (y <= "255"))

        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        return F.when(F.length(d).between(*CARD_DIGITS), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(d).between(*PHONE_DIGITS)
    return F.lit(True)


def _char_class(c: Column) -> Column:
    return (
        F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2).when(c.rlike("^[0-9]"), 3)
        .when(c.rlike("^[\"'=:(<]"), 4).otherwise(5)
    )


def describe(kind: int, x: Column) -> Column:
    """FEATURES small integers of a proposal: the kind, digits, other
    characters, groups of digits, characters before and after, words before,
    first character, separators, the at sign, and the kind's check."""
    m, d = x["m"], F.length(_digits(x["m"]))
    context = reduce(lambda acc, i: F.when(x["before"].rlike(CONTEXT[i]), i + 1).otherwise(acc), range(len(CONTEXT) - 1, -1, -1), F.lit(0))
    marks = sum((F.when(F.contains(m, F.lit(c)), 1 << i).otherwise(0) for i, c in enumerate(". -:")), F.lit(0))
    parts = [
        F.lit(kind), F.least(d, F.lit(20)), F.least(F.length(m) - d, F.lit(12)),
        F.least(F.size(F.split(m, "[^0-9]+")), F.lit(8)), _char_class(F.substr(x["before"], F.lit(-1))),
        _char_class(F.left(x["after"], F.lit(1))), context,
        F.when(m.startswith("+"), 1).when(m.startswith("("), 2).when(m.rlike("^[0-9]"), 3).when(m.rlike("^[A-Za-z]"), 4).otherwise(5),
        marks, F.when(F.contains(m, F.lit("@")), 1).when(m.rlike(r"[(\[]at[)\]]"), 2).otherwise(0),
        F.when(checked(KINDS[kind], m), 1).otherwise(0),
    ]
    return F.array(*[p.cast("int") for p in parts])


SPAN = "struct<k:int,s:int,e:int>"
PROPOSAL = "struct<k:int,s:int,e:int,f:array<int>,y:int>"


def _end(x: Column) -> Column:
    return (x["s"] + F.length(x["m"])).cast("int")


def _checked_hits(kind: str) -> Column:
    found = _hits(F.col("t"), BASE[kind], MAY_HOLD[kind])
    return F.transform(found, lambda x: F.struct(x["m"].alias("m"), x["s"].alias("s"), checked(kind, x["m"]).alias("ok")))


def _base_spans(k: int) -> Column:
    good = F.filter(F.col(f"h{k}"), lambda x: x["ok"])
    return F.transform(good, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), _end(x).alias("e")).cast(SPAN))


def _described(k: int, i: int) -> Column:
    """The i-th generator's proposals of a kind: positive if a base span, negative
    if it fails the check itself, else unlabelled."""

    kind = "struct<s:int,e:int,own:int,m:string,before:string,after:string>"
    none = F.lit(None).cast("string")

    def place(x: Column, own: int, *rest: Column) -> Column:
        return F.struct(x["s"].alias("s"), _end(x).alias("e"), F.lit(own).alias("own"), *rest).cast(kind)

    def row(x: Column) -> Column:
        y = F.when(x["base"], 1).when(~checked(KINDS[k], x["m"]), 0)
        return F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), describe(k, x).alias("f"), y.cast("int").alias("y")).cast(PROPOSAL)

    def told(x: Column, before: Column) -> Column:
        """A span equal to a proposal stands right before it."""
        same = F.coalesce((before["own"] == 0) & (before["s"] == x["s"]) & (before["e"] == x["e"]), F.lit(False))
        return F.struct(*[x[c].alias(c) for c in ("s", "e", "own", "m", "before", "after")], same.alias("base"))

    good = F.transform(F.filter(F.col(f"h{k}"), lambda h: h["ok"]), lambda h: place(h, 0, none, none, none))
    more = F.transform(F.col(f"p{k}_{i}"), lambda x: place(x, 1, x["m"], x["before"], x["after"]))
    both = _let(F.sort_array(F.concat(good, more)), lambda r: F.zip_with(r, _moved(r, kind), told))
    return F.transform(F.filter(both, lambda x: x["own"] == 1), row)


def _moved(values: Column, kind: str) -> Column:
    """Each element's predecessor, null for the first."""
    return F.slice(F.concat(F.array(F.lit(None).cast(kind)), values), F.lit(1), F.size(values))


def proposals(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(id, base, more[, row]): base spans and described proposals of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).alias("id"), text.alias("t"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    for k, kind in enumerate(KINDS):
        out = out.withColumn(f"h{k}", _checked_hits(kind))
        out = out.withColumns({f"p{k}_{i}": _hits(F.col("t"), p, MAY_HOLD[kind]) for i, p in enumerate(PROPOSE[kind])})
    base = [_base_spans(k) for k in range(len(KINDS))]
    more = [_described(k, i) for k, kind in enumerate(KINDS) for i in range(len(PROPOSE[kind]))]
    return out.select("id", F.concat(*base).alias("base"), F.concat(*more).alias("more"), *(["row"] if carry else []))


@dataclass
class Trees:
    """Each tree: (f, v) at the root, and per side (yes, no) a split and two
    leaf values; scores are summed from ``start``. Thresholds by kind."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)

    def score(self, f: Column) -> Column:
        def leaf(side) -> Column:
            (a, b), yes, no = side
            return F.when(F.get(f, F.lit(a)) == b, F.lit(yes)).otherwise(F.lit(no))

        out = F.lit(self.start)
        for (a, b), yes, no in self.trees:
            out = out + F.when(F.get(f, F.lit(a)) == b, leaf(yes)).otherwise(leaf(no))
        return out


def _gain(g: float, h: float, g_all: float, h_all: float) -> float:
    part = lambda a, b: a * a / (b + 1.0)
    return part(g, h) + part(g_all - g, h_all - h)


def grow(spark: SparkSession, made: DataFrame) -> Trees:
    """Boost over counts of equal descriptions. A round is one aggregation over
    them: gradient sums of every pair of (feature, value) conditions, at most
    some thousands of rows whatever the corpus, decide a tree."""
    path = scratch_path(spark, "descriptions")
    rows = made.select("id", F.explode("more").alias("x")).select("x.f", F.col("x.y").alias("y"), F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False)).alias("held"))
    rows.groupBy("f", "y", "held").agg(F.count("*").cast("double").alias("n")).write.parquet(path)
    table = spark.read.parquet(path)
    w = F.col("n") * F.when(F.col("y").isNull(), UNLABELLED).otherwise(1.0)
    label = F.coalesce(F.col("y"), F.lit(0))
    fit = table.where(~F.col("held")).select("f", w.alias("n"), label.alias("y"))
    total = fit.agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).first()
    model = Trees()
    if not total[0]:
        return model
    p = min(max(total[1] / total[0], 0.01), 0.99)
    model.start = log(p / (1 - p))
    conditions = F.transform(F.col("f"), lambda v, i: F.struct(i.cast("int").alias("i"), v.alias("v")))
    for _ in range(TREES):
        prob = 1 / (1 + F.exp(-model.score(F.col("f"))))
        now = fit.select(conditions.alias("c"), (F.col("n") * (prob - F.col("y"))).alias("g"), (F.col("n") * prob * (1 - prob)).alias("h"))
        pairs = now.select(F.explode("c").alias("a"), "c", "g", "h").select("a", F.explode("c").alias("b"), "g", "h")
        sums = {((r[0][0], r[0][1]), (r[1][0], r[1][1])): (r[2], r[3]) for r in pairs.groupBy("a", "b").agg(F.sum("g"), F.sum("h")).collect()}
        single = {a: s for (a, b), s in sums.items() if a == b}
        first = next(iter(single))[0]
        g_all = sum(s[0] for a, s in single.items() if a[0] == first)
        h_all = sum(s[1] for a, s in single.items() if a[0] == first)
        root = max(sorted(single), key=lambda a: _gain(*single[a], g_all, h_all))

        def side(part: dict, g: float, h: float):
            best = max(sorted(part), key=lambda a: _gain(*part[a], g, h))
            x, y = part[best]
            return best, -RATE * x / (y + 1.0), -RATE * (g - x) / (h - y + 1.0)

        yes = {b: sums.get((root, b), (0.0, 0.0)) for b in single}
        no = {b: (single[b][0] - yes[b][0], single[b][1] - yes[b][1]) for b in single}
        g, h = single[root]
        model.trees.append((root, side(yes, g, h), side(no, g_all - g, h_all - h)))
    # thresholds: the held-out descriptions in order of score (bounded, as above)
    score = F.round(model.score(F.col("f")), 3)
    held = table.where("held").groupBy(F.get("f", F.lit(0)).alias("k"), score.alias("z")).agg(F.sum(w).alias("n"), F.sum(w * label).alias("y")).collect()
    for k in range(len(KINDS)):
        n = y = 0.0
        for r in sorted((r for r in held if r["k"] == k), key=lambda r: -r["z"]):
            n, y = n + r["n"], y + r["y"]
            if y >= PRECISION * n:
                model.thresholds[k] = r["z"]
    return model


def _meets(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def _free(base: Column, more: Column) -> Column:
    """Of ``more``, array<(s, e, k, z)>, those that meet no base span, in order
    of start: in the order of all starts, no span begins before a proposal and
    ends in or behind it, and none begins behind its start and before its end."""
    kind = "struct<s:int,e:int,k:int,z:double>"
    spans = F.transform(base, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"), F.lit(-1).alias("k"), F.lit(0.0).alias("z")).cast(kind))

    def place(rows: Column) -> Column:
        ends = _scan(F.transform(rows, lambda x: F.when(x["k"] < 0, x["e"])), lambda x, y: F.greatest(x, y))
        starts = F.reverse(_scan(F.reverse(F.transform(rows, lambda x: F.when(x["k"] < 0, x["s"]))), lambda x, y: F.least(x, y)))
        near = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("e"), s.alias("s")))
        told = F.zip_with(rows, near, lambda x, n: F.struct(x.alias("x"), (F.coalesce(n["e"] > x["s"], F.lit(False)) | F.coalesce(n["s"] < x["e"], F.lit(False))).alias("meets")))
        return F.transform(F.filter(told, lambda r: (r["x"]["k"] >= 0) & ~r["meets"]), lambda r: r["x"])

    return _let(F.sort_array(F.concat(spans, more)), place)


def _best(found: Column) -> Column:
    """The spans of proposals, array<(s, e, k, z)> in order of start, taken best
    score first, without those that meet one already taken. Each run of
    proposals that overlap one another is judged alone."""
    kind = f"array<{SPAN}>"

    def greedy(run: Column) -> Column:
        ordered = F.sort_array(F.transform(run, lambda x: F.struct((-x["z"]).alias("z"), x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))))
        return F.aggregate(
            ordered, F.array().cast(kind),
            lambda acc, x: F.when(F.exists(acc, lambda b: _meets(x, b)), acc).otherwise(F.concat(acc, F.array(F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")).cast(SPAN)))),
        )

    def runs(rows: Column) -> Column:
        ends = _let(_scan(F.transform(rows, lambda x: x["e"]), lambda x, y: F.greatest(x, y)), lambda v: _moved(v, "int"))
        first = F.zip_with(rows, ends, lambda x, e: F.coalesce(e <= x["s"], F.lit(True)))
        starts = F.filter(F.transform(first, lambda new, i: F.when(new, i + 1)), lambda i: i.isNotNull())
        stops = lambda at: F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(rows) + 1))
        cuts = _let(starts, lambda at: F.zip_with(at, stops(at), lambda i, j: F.struct(i.alias("i"), (j - i).alias("n"))))
        return F.flatten(F.transform(F.filter(cuts, lambda c: c["i"].isNotNull()), lambda c: greedy(F.slice(rows, c["i"], c["n"]))))

    return _let(found, runs)


def find_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(id, base, spans[, row]) of each row: arrays of (k, s, e), the kind's number
    in KINDS, start and end in code points (end exclusive), by kind and start;
    ``spans`` holds the base spans and the added ones.

    Null and empty texts have none; whole texts are searched; equal texts have
    equal spans; without proposals nothing is added; an empty table gives none;
    other columns are only carried inside ``row``.
    """
    path = scratch_path(spark, "proposals")
    proposals(docs, id_col, text_col, carry).write.parquet(path)
    made = spark.read.parquet(path)
    model = grow(spark, made)
    scored = F.transform("more", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), F.round(model.score(x["f"]), 3).alias("z")))
    above = lambda x: x["z"] >= reduce(lambda acc, k: F.when(x["k"] == k, model.thresholds[k]).otherwise(acc), model.thresholds, F.lit(1e9))
    taken = _best(_free(F.col("base"), F.filter(scored, above)))
    some = F.size("more") > 0
    out = made.withColumn("spans", F.when(some, F.sort_array(F.concat("base", taken))).otherwise(F.col("base")))
    return out.select(F.col("id").alias(id_col), "base", "spans", *(["row"] if carry else []))


def is_kind(k: int):
    """A test of a kind's number."""
    return lambda x: x == k


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))))


CHUNK = 1024  # code points; a span's text is cut out of the chunks that hold it


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by the
    first one's kind in brackets. Time grows with the text and the spans, not
    with their product."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def cut(chunks: Column, a: Column, b: Column) -> Column:
        i = F.floor(a / CHUNK).cast("int")
        held = F.array_join(F.slice(chunks, i + 1, F.floor((b - 1) / CHUNK).cast("int") - i + 1), "")
        return F.when(a < b, F.substring(held, a - i * CHUNK + 1, b - a)).otherwise(F.lit(""))

    def build(chunks: Column, rows: Column) -> Column:
        def join(ends: Column) -> Column:
            done = F.transform(_moved(ends, "int"), lambda e: F.coalesce(e, F.lit(0)))
            parts = F.zip_with(rows, done, lambda x, e: F.when(x["s"] >= e, F.concat(cut(chunks, e, x["s"]), F.get(names, x["k"]))).otherwise(F.lit("")))
            return F.concat(F.array_join(parts, ""), cut(chunks, F.element_at(ends, -1), F.length(text)))

        return _let(_scan(F.transform(rows, lambda x: x["e"]), lambda x, y: F.greatest(x, y)), join)

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    done = _let(chunks, lambda c: _let(ordered, lambda rows: build(c, rows)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
