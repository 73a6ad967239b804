"""Benchmark passages in documents by winnowing, in DataFrame functions only.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
A window is ``width`` consecutive words of a benchmark text, or all the words of
a shorter text. A window's fingerprint is the least hash of the k-grams in it, so
a span of ``width`` words or more that a document shares with an item has the same
fingerprint in both, whatever stands around it: none is missed.

1. The benchmark's distinct windows and their fingerprints are written.
2. One pass over the documents finds each window's fingerprint. A bitmap of the
   benchmark's fingerprints, of a fixed largest size, lets through those that can
   join (and a few others). These few windows are written with their words.
3. They are joined to the benchmark's on fingerprint and words, so a window of
   a document meets at most one of the benchmark, however common it is.
4. Adjacent and overlapping windows are extended to spans. Documents that share
   the same set of windows are one class, for which the items are listed once.

Texts are read once and never shuffled; no window meets another in pairs.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import write_scratch

# Between words: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 5
BITS_EACH = 64  # bits of the bitmap for each fingerprint, so that 1 in 64 others passes
MAP_BITS = (1 << 16, 1 << 24)  # least and most; a fuller map lets more windows through to the join

WINDOW = "struct<at:int,len:int,fp:bigint,words:string>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is A-Z only where every character is one byte
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.filter(F.split(low, BETWEEN, -1), lambda w: w != F.lit(""))


def _grams(names: Column, k: int) -> Column:
    """Hash of the k words from each position on (the last k - 1 are no k-gram)."""
    return F.transform(names, lambda _, i: F.xxhash64(*[F.get(names, i + F.lit(j)) for j in range(k)]))


def _fingerprint(grams: Column, at: Column, n: int) -> Column:
    least = [F.get(grams, at + F.lit(j)) for j in range(n)]
    return F.least(*least) if n > 1 else least[0]


def windows_of(words: Column, lengths: list[int], k: int, passes=None) -> Column:
    """array<WINDOW>: the windows of each of the lengths, those whose fingerprint
    ``passes`` if a test is given."""

    def found(names: Column) -> Column:
        sizes = sorted({min(k, m) for m in lengths})
        return F.concat(*[let(_grams(names, size), of_size(size)) for size in sizes])

    def of_size(size: int):
        these = [m for m in lengths if min(k, m) == size]
        return lambda grams: F.concat(*[of_length(grams, m, m - size + 1) for m in these])

    def of_length(grams: Column, m: int, n: int) -> Column:
        last = F.size(words) - F.lit(m)
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        if passes:
            at = F.filter(at, lambda i: passes(_fingerprint(grams, i, n)))
        text = lambda i: F.concat_ws(" ", *[F.get(words, i + F.lit(j)) for j in range(m)])
        return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(m).alias("len"), _fingerprint(grams, i, n).alias("fp"), text(i).alias("words")).cast(WINDOW))

    return let(F.transform(words, lambda w: F.xxhash64(w)), found)


def _bitmap(fingerprints: DataFrame):
    """A test that every given fingerprint passes, and few others. The map's size
    goes with the number of fingerprints up to a fixed bound (2 MB)."""
    n = fingerprints.count()
    bits = MAP_BITS[0]
    while bits < min(n * BITS_EACH, MAP_BITS[1]):
        bits *= 2
    place = F.col("fp").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    cells = fingerprints.groupBy(F.shiftright(place, 6).cast("int").alias("cell")).agg(F.bit_or(one).alias("bits"))
    table = [0] * (bits // 64)
    for r in cells.collect():  # at most bits / 64 rows
        table[r.cell] = r.bits
    held = F.from_json(F.lit(json.dumps(table)), "array<bigint>")  # folded into a literal by the optimizer

    def passes(fp: Column) -> Column:
        cell = F.get(held, F.shiftright(fp.bitwiseAND(F.lit(bits - 1)), 6).cast("int"))
        return F.call_function("shiftrightunsigned", cell, fp.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return passes


def spans_of(hits: Column, width: int) -> Column:
    """array<struct<start,end>>: an array of (at, len) windows, of ``width`` words
    at most, extended to the longest spans that they cover, in order."""

    def longest(h: Column) -> Column:
        return F.filter(h, lambda x, i: F.coalesce(F.get(h, i + 1)["at"] != x["at"], F.lit(True)))

    def reached(h: Column) -> Column:
        # a window that reaches this one begins at one of the width - 1 words before it
        ends = lambda i: [(F.get(h, i - F.lit(j))["at"] + F.get(h, i - F.lit(j))["len"]) for j in range(1, width)]
        return F.transform(h, lambda x, i: F.struct(x["at"].alias("at"), (x["at"] + x["len"]).alias("end"), F.greatest(F.lit(-1), F.lit(-1), *ends(i)).alias("reach")))

    def spans(h: Column) -> Column:
        begins = lambda x: x["at"] > x["reach"]
        first = F.transform(F.filter(h, begins), lambda x: x["at"])
        last = F.filter(h, lambda x, i: F.coalesce(begins(F.get(h, i + 1)), F.lit(True)))
        last = F.transform(last, lambda x: F.greatest(x["end"], x["reach"]))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), b.alias("end")))

    return let(let(let(F.array_sort(hits), longest), reached), spans)


def contamination(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    k: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, spans, items) of each row of ``docs``.

    ``spans`` are the words (from, to; end exclusive) under windows of benchmark
    texts, ``n_hit`` their number and ``items`` the ids, as text and sorted, of
    the items that have an occurring window. Null and empty texts have no words on
    either side and no windows; repeated rows have repeated results; a repeated
    item id is listed once; windows of an item without an id are hit but not
    listed; an empty benchmark hits nothing, empty documents give an empty
    result. Only the four named columns are read. Words are compared themselves,
    hashes only choose what is compared.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(item_text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("m", F.least(F.size("w"), F.lit(width)))
    lengths = sorted(r.m for r in items.select("m").distinct().collect())  # at most ``width`` values
    whole = reduce(lambda acc, m: F.when(F.col("m") == m, windows_of(F.col("w"), [m], k)).otherwise(acc), lengths, F.array().cast(f"array<{WINDOW}>"))
    listed = items.select("item", F.explode(F.array(F.col("w"))).alias("w"), "m").select("item", F.explode(whole).alias("x"))
    known = listed.select("item", "x.len", "x.fp", "x.words").distinct()
    known = spark.read.parquet(write_scratch(known, "item-windows"))
    targets = known.groupBy("fp", "words").agg(F.min("len").alias("len")).withColumn("window", F.monotonically_increasing_id())
    targets = spark.read.parquet(write_scratch(targets, "windows"))

    passes = _bitmap(targets.select("fp").distinct())
    src = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    src = src.select("id", F.explode(F.array("w")).alias("w"))  # computed once for what follows
    rows = src.select("id", F.size("w").cast("long").alias("n_words"), (windows_of(F.col("w"), lengths, k, passes) if lengths else F.array().cast(f"array<{WINDOW}>")).alias("x"))
    rows = spark.read.parquet(write_scratch(rows.withColumn("no", F.monotonically_increasing_id()), "document-windows"))

    asked = rows.where(F.size("x") > 0).select("no", F.explode("x").alias("x")).select("no", "x.at", "x.fp", "x.words")
    met = asked.join(targets, ["fp", "words"]).select("no", "at", "len", "window")
    per_row = met.groupBy("no").agg(F.collect_list(F.struct("at", "len")).alias("hits"), F.array_sort(F.collect_set("window")).alias("windows"))
    per_row = spark.read.parquet(write_scratch(per_row.select("no", spans_of(F.col("hits"), width).alias("spans"), "windows"), "hits"))

    # documents of the same windows are one class
    wanted = per_row.select("windows").distinct().select("windows", F.explode("windows").alias("window"))
    named = known.where("item is not null").join(targets, ["fp", "words"]).select("window", "item").distinct()
    classes = wanted.join(named, "window").groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("items"))
    classes = spark.read.parquet(write_scratch(classes, "classes"))
    hit = per_row.join(classes, "windows", "left").select("no", "spans", "items")

    none = F.array().cast("array<struct<start:int,end:int>>")
    out = rows.select("no", "id", "n_words").join(hit, "no", "left")
    spans = F.coalesce("spans", none)
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]).cast("long"))
    return out.select(F.col("id").alias(id_col), "n_words", total.alias("n_hit"), spans.alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
