"""Market ticks: parse, indicator rows, feed bodies, EMA and MACD (B6, B7, B10,
T1-T3, T5, A19, X6-X8).

EMA as the reference writes it (D2 fixed): seed ``e = x0``, ``k = 2/(n+1)``
with ``n`` the number of values, then ``e = x*k + e*(1-k)`` for every following
value; MACD = EMA(first 12 values of the window) - EMA(all values).

Unrolled, the fold is a weighted sum::

    EMA = x0*(1-k)^(n-1) + sum_{r>=1} x_r * k * (1-k)^(n-1-r)

where ``r`` is the 0-based rank of the value in (event time, sequence) order.
The batch operators use this form: a tick is ranked inside its key's time bucket,
and the ticks of the buckets before it are a running sum over bucket counts (a
small table), so one busy instrument is split over many tasks by one hash
shuffle; the EMA is a plain ``sum`` with map-side partial aggregation. No window's values are ever
collected into one array, however many ticks it holds. The streaming form
(windows closed by the watermark) keeps the window's values in state and folds
the sorted list with ``aggregate``; ``ema_fold`` builds that expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import ticks as T

INDICATOR_SCHEMA = "key string, type string, value double, split string"
SHORT_SPAN = 12  # Fixed value: the fast EMA takes the first 12 values.


# ---------------------------------------------------------------- parsing


def parse_ticks(df: DataFrame, value_col: str = "value", seq_col: str | None = None) -> DataFrame:
    """Decode records (plain or JSON-quoted), split into fields and keep the
    valid ones. Adds ``key``, ``fields``, ``event_time`` and ``seq`` (the
    arrival order tie-break: ``seq_col`` if given, e.g. the Kafka offset).

    Decoding and splitting happen once per record: the (record, fields) pair
    is produced by a one-element ``explode``, whose output the optimizer does
    not copy into the filters that follow (a plain projection would be
    inlined into every pushed-down predicate and re-split per predicate)."""
    seq = F.col(seq_col) if seq_col else F.lit(None).cast("long")
    decoded = df.select(seq.alias("seq"), T.decode_record(F.col(value_col).cast("string")).alias("record"))
    pair = F.array(F.struct(F.col("record"), T.tick_fields(F.col("record")).alias("fields")))
    out = decoded.select("seq", F.explode(pair).alias("_t")).select("seq", "_t.record", "_t.fields")
    out = out.filter(T.is_valid(F.col("fields")))
    return out.select(
        F.get(F.col("fields"), T.KEY_FIELD).alias("key"),
        "record",
        "fields",
        T.event_time(F.col("fields")).alias("event_time"),
        "seq",
    )


def indicator_rows(parsed: DataFrame, full_time: bool = False) -> DataFrame:
    """One tick to (key, "AMO", field 12, time) and (key, "OBV",
    field 11, time), in that order; ``split`` is field 32, the time text.
    With ``full_time`` the time column is the full timestamp (D9), for the
    table sink. Indicator values that are not numbers are dropped."""
    f = F.col("fields")
    time_col = F.col("event_time") if full_time else F.get(f, T.TIME_FIELD)
    time_name = "time" if full_time else "split"
    rows = F.array(
        F.struct(F.lit("AMO").alias("type"), T.number(f, T.AMO_FIELD).alias("value")),
        F.struct(F.lit("OBV").alias("type"), T.number(f, T.OBV_FIELD).alias("value")),
    )
    return (
        parsed.select("key", time_col.alias(time_name), F.explode(rows).alias("r"))
        .select("key", "r.type", "r.value", time_name)
        .filter(F.col("value").isNotNull())
    )


def to_kafka_records(rows: DataFrame, key_col: str = "key") -> DataFrame:
    """(key, JSON of the whole row) text pair for a Kafka sink."""
    return rows.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value"),
    )


# ------------------------------------------------------------ feed bodies


def feed_to_ticks(bodies: DataFrame, body_col: str = "body", day: str | None = None) -> DataFrame:
    """Quote-feed response bodies to tick records: split on ``;``, take
    the third ``_`` piece, ``=`` to ``,``, drop quotes, keep records of more
    than 30 fields and (P14) whose field 31 equals ``day`` when given. As in
    ``parse_ticks``, one-element explodes keep each entry's splits single."""
    entries = bodies.select(F.explode(T.body_lines(F.col(body_col))).alias("entry"))
    recs = entries.select(F.explode(F.array(T.entry_to_record(F.col("entry")))).alias("record")).filter(F.col("record").isNotNull())
    recs = recs.select("record", F.explode(F.array(T.tick_fields(F.col("record")))).alias("fields")).filter(T.is_valid(F.col("fields")))
    if day is not None:
        recs = recs.filter(F.get(F.col("fields"), T.DATE_FIELD) == F.lit(day))
    return recs


# ----------------------------------------------------------------- EMA weights


def _k(n: Column) -> Column:
    return F.lit(2.0) / (n.cast("double") + F.lit(1.0))


def ema_weight(r: Column, n: Column) -> Column:
    """Weight of the value of rank ``r`` (0-based) in the EMA of ``n`` values."""
    k = _k(n)
    return F.when(r == 0, F.pow(F.lit(1.0) - k, n - 1)).otherwise(k * F.pow(F.lit(1.0) - k, n - 1 - r))


def short_ema_weight(r: Column, n: Column, span: int = SHORT_SPAN, latest: bool = False) -> Column:
    """Weight in the EMA of the first ``span`` values of the window (or the
    latest ``span`` with ``latest``)."""
    m = F.least(n, F.lit(span))
    rr = r - (n - m) if latest else r
    return F.when((rr < 0) | (rr >= m), F.lit(0.0)).otherwise(ema_weight(rr, m))


def ema_fold(values: Column) -> Column:
    """The sequential fold over an ordered array (streaming form, oracle for
    the weighted sum). ``k`` rides in the accumulator: an outer expression
    referenced inside the lambda would be re-evaluated for every element."""
    n = F.size(values)
    init = F.struct(F.get(values, 0).alias("e"), _k(n).alias("k"))
    return F.aggregate(
        F.slice(values, 2, F.greatest(n - 1, F.lit(0))),
        init,
        lambda acc, x: F.struct(
            (x * acc["k"] + acc["e"] * (F.lit(1.0) - acc["k"])).alias("e"), acc["k"].alias("k")
        ),
        lambda acc: acc["e"],
    )


def macd_fold(values: Column, span: int = SHORT_SPAN) -> Column:
    """X6 + B7: EMA(first ``span``) - EMA(all) over an ordered array."""
    return ema_fold(F.slice(values, 1, span)) - ema_fold(values)


# --------------------------------------------------------------- batch EMA


def tick_values(parsed: DataFrame) -> DataFrame:
    """(key, event_time, seq, x) with x = field 11, the index input of the
    reference's EMA (D1 fixed)."""
    return parsed.select(
        "key", "event_time", "seq", T.number(F.col("fields"), T.OBV_FIELD).alias("x")
    ).filter(F.col("x").isNotNull() & F.col("event_time").isNotNull())


EMA_BUCKET_S = 1800  # seconds of a bucket in which a key's ticks are ranked


def _bucketed(values: DataFrame, bucket_s: int) -> tuple[DataFrame, DataFrame]:
    """Ticks with their bucket ``b`` and rank ``r0`` in it, and one row per
    bucket: its ticks ``bn``, first time ``bt`` and the key's ticks before it,
    ``before``. The running sum is over buckets, not over ticks."""
    secs = F.unix_micros(F.col("event_time").cast("timestamp")) / F.lit(1_000_000)
    placed = values.select("key", "event_time", "seq", "x", F.floor(secs / bucket_s).cast("long").alias("b"))
    inside = Window.partitionBy("key", "b").orderBy("event_time", "seq")
    ranked = placed.withColumn("r0", F.row_number().over(inside) - 1)
    buckets = placed.groupBy("key", "b").agg(F.count(F.lit(1)).alias("bn"), F.min("event_time").alias("bt"))
    earlier = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return ranked, buckets.withColumn("before", F.coalesce(F.sum("bn").over(earlier), F.lit(0)))


def ema_by_key(values: DataFrame, span: int = SHORT_SPAN, digits: int = 6) -> DataFrame:
    """EMA over all of a key's values, EMA of its first ``span`` values and
    their difference (MACD), one row per key. Ticks meet their bucket's row on
    (key, bucket), so a busy key is many groups until the final sum."""
    ranked, buckets = _bucketed(values, EMA_BUCKET_S)
    total = F.sum("bn").over(Window.partitionBy("key")).alias("n")
    joined = ranked.join(buckets.select("key", "b", "before", total), ["key", "b"])
    r, n = F.col("before") + F.col("r0"), F.col("n")
    agg = joined.groupBy("key", "n").agg(
        F.sum(F.col("x") * ema_weight(r, n)).alias("ema_all"),
        F.sum(F.col("x") * short_ema_weight(r, n, span)).alias("ema_short"),
    )
    return agg.select(
        "key",
        "n",
        F.round("ema_short", digits).alias("ema_short"),
        F.round("ema_all", digits).alias("ema_all"),
        F.round(F.col("ema_short") - F.col("ema_all"), digits).alias("macd"),
    )


def bucket_windows(buckets: DataFrame, m: int) -> DataFrame:
    """(key, b, wb, g0, n, t0, before): every bucket beside each of its ``m``
    windows (the one starting at bucket wb covers wb .. wb + m - 1) with the
    window's first rank, size and first time: buckets x m rows, both sides."""
    mine = buckets.select("key", "b", "before", "bn", "bt", F.explode(F.sequence(F.col("b") - (m - 1), F.col("b"))).alias("wb"))
    windows = mine.groupBy("key", "wb").agg(F.min("before").alias("g0"), F.sum("bn").alias("n"), F.min("bt").alias("t0"))
    return mine.select("key", "b", "wb", "before").join(windows, ["key", "wb"])


def macd_windows(
    values: DataFrame,
    window: str = "26 minutes",
    slide: str = "1 minute",
    span: int = SHORT_SPAN,
    latest: bool = False,
    digits: int = 6,
) -> DataFrame:
    """T2 + B7: per key and sliding event-time window, MACD = EMA(first
    ``span`` values) - EMA(all values); ``split`` is the time text of the
    window's first record (the reference's row time). Windows are those of
    ``F.window(event_time, window, slide)``.

    Every tick lies in ``m = window / slide`` windows. The window facts come
    from per-slide-bucket rows expanded to their ``m`` windows; each bucket then
    carries the list of these (at most ``m``), and the ticks meet it in a join
    on (key, bucket), the partitioning in which they were ranked. They are
    expanded to their windows after that, into a partial aggregate: ticks are
    shuffled once, never ``m`` times."""
    window_s = _seconds(window)
    slide_s = _seconds(slide)
    if window_s % slide_s:
        raise ValueError("window must be a multiple of slide")
    ranked, buckets = _bucketed(values, slide_s)
    per_bucket = bucket_windows(buckets, window_s // slide_s).groupBy("key", "b").agg(F.collect_list(F.struct("wb", "g0", "n", "t0", "before")).alias("ws"))
    exploded = ranked.join(per_bucket, ["key", "b"]).select("r0", "x", "key", F.explode("ws").alias("w"))
    r = F.col("w.before") + F.col("r0") - F.col("w.g0")
    n = F.col("w.n")
    agg = exploded.groupBy("key", F.col("w.wb").alias("wb"), n.alias("n"), F.col("w.t0").alias("t0")).agg(
        F.sum(F.col("x") * ema_weight(r, n)).alias("ema_all"),
        F.sum(F.col("x") * short_ema_weight(r, n, span, latest)).alias("ema_short"),
    )
    start = F.timestamp_seconds(F.col("wb") * slide_s)
    return agg.select(
        "key",
        start.alias("window_start"),
        (start + F.expr(f"INTERVAL {window_s} SECONDS")).alias("window_end"),
        "n",
        F.lit("MACD").alias("type"),
        F.round(F.col("ema_short") - F.col("ema_all"), digits).alias("value"),
        F.date_format("t0", "HH:mm:ss").alias("split"),
    )


def _seconds(d: str) -> int:
    num, unit = d.split()
    unit = unit.rstrip("s").lower()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(num) * mult


# ------------------------------------------------------- window aggregates


def window_stats(values: DataFrame, window: str, slide: str | None = None, prebucket: bool = True) -> DataFrame:
    """Tick count and exact value total per key and event-time window
    (tumbling without ``slide``). Totals are summed as decimals of ten places.

    Sliding windows (``window`` a multiple of ``slide``) are rolled up from
    per-slide-bucket partial results: each tick is aggregated once into its
    bucket, and only the bucket rows are expanded to the ``window / slide``
    windows holding them, instead of every tick. ``prebucket=False`` keeps
    Spark's own window expansion (needed on streams, where the window column
    carries the watermark)."""
    exact = F.col("x").cast("decimal(28,10)")
    ws, ss = _seconds(window), (_seconds(slide) if slide else None)
    if prebucket and ss and ws % ss == 0 and ws > ss:
        m = ws // ss
        secs = F.unix_micros(F.col("event_time").cast("timestamp")) / F.lit(1_000_000)
        per_bucket = values.groupBy("key", F.floor(secs / ss).cast("long").alias("b")).agg(
            F.count(F.lit(1)).alias("bn"), F.sum(exact).alias("bc")
        )
        rolled = (
            per_bucket.select("key", "bn", "bc", F.explode(F.sequence(F.col("b") - (m - 1), F.col("b"))).alias("wb"))
            .groupBy("key", "wb")
            .agg(F.sum("bn").alias("n"), F.sum("bc").alias("_c"))
        )
        start = F.timestamp_seconds(F.col("wb") * ss)
        return rolled.select(
            "key",
            start.alias("window_start"),
            (start + F.expr(f"INTERVAL {ws} SECONDS")).alias("window_end"),
            "n",
            F.col("_c").cast("double").alias("total"),
        )
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return (
        values.groupBy("key", w.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact).alias("_c"),
        )
        .select(
            "key",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n",
            F.col("_c").cast("double").alias("total"),
        )
    )


CHUNK = 1000  # most items of one row of concat_groups


def concat_groups(parsed: DataFrame, window: str = "26 minutes", item: Column | None = None, part: str = "1 minute", chunk: int = CHUNK) -> DataFrame:
    """Per key and tumbling window, the concatenation of every
    tick's array (the reference's commented ``reduceGroups(_ ++ _)``) in rows of
    bounded size: (key, window_start, part, chunk, items). A window is cut in
    parts of time, a part in chunks of at most ``chunk`` ticks by time and
    sequence; all chunks in order are the whole group, no element is lost."""
    item = item if item is not None else F.array(F.col("record"))
    step = _seconds(part)
    rows = parsed.select("key", "event_time", "seq", item.alias("item"), F.window("event_time", window)["start"].alias("window_start"))
    offset = F.unix_seconds("event_time") - F.unix_seconds("window_start")
    rows = rows.withColumn("part", F.floor(offset / step).cast("int"))
    order = Window.partitionBy("key", "window_start", "part").orderBy("event_time", "seq")
    rows = rows.withColumn("chunk", F.floor((F.row_number().over(order) - 1) / chunk).cast("int"))
    return rows.groupBy("key", "window_start", "part", "chunk").agg(F.flatten(F.collect_list("item")).alias("items"))
