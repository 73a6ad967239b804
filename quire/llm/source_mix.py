"""Mixing sources to target weights by a low-discrepancy slot schedule.

The mix is a sequence of slots, each one block of words of one source. Slot i
takes the point frac(i * golden ratio), mapped through the sources' cumulative
shares of the slots; the slots of a source are ranked, and rank r takes block r
modulo the source's number of blocks. A source's documents, shuffled by a hash
of their id and text, are laid end to end and cut into blocks of equal words, so
a source is taken evenly and as often as its share asks. Blocks keep their size
however large the corpus, a small source has smaller ones, and a source's share
of the slots is its target in its own blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PHI = 0.6180339887498949
PHI_HIGH = 0.607787409740351  # fractional part of 2^20 times the golden ratio
WORD_RE = r"[^\x20\x09-\x0D]+"
LEAST_BLOCKS = 1024  # of a source, or one for each word
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for null), without building them: word
    starts are counted after every other byte class is folded away."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def capped_targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target): sources in code point order, null last,
    weigh 1, 2, 3 repeating and share all words; a target stops at ``cap`` times
    its source's size and the excess goes to the others by weight.

    With sources ordered by size/weight, the saturated ones are a prefix: the
    smallest prefix after which the remaining words per weight are below the
    next source's cap. Source sizes are one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = sizes.withColumn("i", F.row_number().over(order) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int")))
    w = w.withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    seq = Window.orderBy("ratio", "i")
    upto = seq.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = (
        w.withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum(cap * F.col("source_size")).over(upto), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        .withColumn("level", F.col("left_words") / F.col("left_weight"))
        .withColumn("open", F.col("level") <= F.col("ratio"))
    )
    # the first source that isn't saturated sets the level of all behind it
    level = F.min(F.when(F.col("open"), F.struct("ratio", "i", "level"))).over(every)["level"]
    return w.withColumn("level", level).select(
        "source", "i", "source_size", F.least(cap * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), cap * F.col("source_size"))).alias("target")
    )


def schedule(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """(i, slot): the sources' slots, from (i, want), the slots each source is due.
    A source is found through a grid of the unit interval: an interval of cumulative
    share covers some cells, a point lies in one, and cells are joined by equality."""
    slots, sources = wanted.agg(F.coalesce(F.sum("want"), F.lit(0.0)), F.count("*")).first()
    slots, cells = math.ceil(slots), max(4096, 4 * sources)
    share = F.coalesce(F.try_divide(F.col("want"), F.sum("want").over(Window.partitionBy())), F.lit(0.0))
    t = wanted.withColumn("share", share)
    upto = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("hi", F.sum("share").over(upto)).withColumn("last", F.max("i").over(Window.partitionBy()) == F.col("i"))
    t = t.withColumn("hi", F.when(F.col("last"), 2.0).otherwise(F.col("hi")))
    t = t.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("i")), F.lit(0.0)))
    grid = t.select(
        "i", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * cells).cast("int"), F.least(F.floor(F.col("hi") * cells), F.lit(cells)).cast("int"))).alias("cell"),
    )
    # the high and low bits of a slot's number apart, so that no digit is lost
    x = F.shiftright("id", 20) * F.lit(PHI_HIGH) + F.col("id").bitwiseAND(F.lit((1 << 20) - 1)) * F.lit(PHI)
    points = spark.range(slots).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * cells).cast("int"))
    return points.join(grid, "cell").where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi"))).select("i", "slot")


def mix(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cap: int = 3,
    min_block: int = 64,
    carry: bool = False,
) -> DataFrame:
    """(id, size, source_size, target, taken) of each row, and the row itself as
    the struct ``row`` if ``carry``.

    ``taken`` is the words the mix takes from the document, repeats counted; at
    most ``cap`` times its size. Null and empty texts have size 0 and nothing
    taken; null is a source of its own; equal rows are mixed as separate
    documents laid side by side; an empty table gives none; other columns are
    only carried inside ``row`` and can't clash. A source's blocks are equal and of
    at most ``min_block`` words; a source has 1,024 or more of them, or one for
    each word, so a target is missed by some slots of the source's own size.
    """
    from quire.session import write_scratch

    cols = [F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")]
    cols += [F.xxhash64(F.col(id_col), F.col(text_col), F.lit(8)).alias("h"), F.monotonically_increasing_id().alias("no")]
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    path = write_scratch(docs.select(*cols, *whole), "mix-rows")
    # everything is computed on these narrow columns; whole rows are met once, at the end
    sizes = rows = spark.read.parquet(path).select("no", "id", "source", "size", "h")

    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = capped_targets(per_source, float(cap))
    blocks = F.greatest(F.ceil(F.col("source_size") / min_block), F.least("source_size", F.lit(LEAST_BLOCKS)))
    want = F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")), F.lit(0.0))
    targets = spark.read.parquet(write_scratch(targets.withColumn("blocks", blocks).withColumn("want", want), "mix-targets"))
    ranked = schedule(spark, targets.select("i", "want")).groupBy("i").agg(F.count("*").alias("slots"))
    plan = (
        targets.join(ranked, "i", "left")
        .withColumn("slots", F.least(F.coalesce("slots", F.lit(0)), cap * F.col("blocks")))
        .select(F.col("source").alias("s"), "source_size", "target", "blocks", "slots")
    )

    # Place of each document in its source's shuffled order: words of the hash
    # buckets before its own, then of the rows before it in the bucket.
    bucket = F.pmod(F.shiftright("h", 20), F.lit(BUCKETS))
    rows, keyed = rows.withColumn("bucket", bucket), sizes.withColumn("bucket", bucket)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")), "left").drop("s", "b")
    rows = rows.withColumn("at", F.col("base") + F.col("inside"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")

    # Block k of a source is taken once for each rank r = k modulo its blocks.
    # The ranks give each block `full` rounds, and one more to the first `rest`,
    # which end at the word `edge`; cuts lie at equal parts of the source.
    full = F.floor(F.col("slots") / F.greatest(F.col("blocks"), F.lit(1)))
    rest = F.col("slots") - full * F.col("blocks")
    edge = F.floor(rest * F.col("source_size").cast("decimal(20,0)") / F.greatest(F.col("blocks"), F.lit(1))).cast("long")
    more = F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), edge) - F.least(F.col("at"), edge))
    taken = F.when(F.col("size") > 0, full * F.col("size") + more).otherwise(0).cast("long")
    found = rows.select(*(["no"] if carry else []), F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))
    if not carry:
        return found
    # both sides grow with the corpus: a sort-merge join at any size
    return spark.read.parquet(path).select("no", "row").join(found.hint("merge"), "no").select(id_col, "size", "source_size", "target", "taken", "row")
