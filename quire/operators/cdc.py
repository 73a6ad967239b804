"""Change data capture: decode change events and apply them to a replica
(B11, B12).

Events are (key, value) JSON documents with a before / after / source / op /
ts_ms envelope (a "schema" part, when present, is ignored). A document is parsed
once, to a VARIANT, and its fields are read from that; fields of later versions
of a table or connector are read the same way, by their path. Applying keeps the
last change per key - ordered by (ts_ms, binlog file number, position, row) - and
drops keys whose last change is a delete. ``max_by`` is a partial aggregate,
so a key with many changes is pre-reduced in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.variant import parsed

ROW_SCHEMA = "struct<id: bigint, first_name: string, last_name: string, email: string>"


def cdc_decode(events: DataFrame, key_col: str = "key", value_col: str = "value", also: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Envelope to (op, id, before, after, source position, ts_ms). The
    id comes from the key document, so deletes (null ``after``) keep it. ``also``
    adds columns from any path of the value: name -> (path below the payload,
    type), null where an event lacks it."""
    docs = parsed(events, {"k": F.col(key_col), "v": F.col(value_col)})
    get = lambda path, kind: F.try_variant_get("v", f"$.payload.{path}", kind)
    ids = [F.try_variant_get("k", "$.payload.id", "bigint"), get("after.id", "bigint"), get("before.id", "bigint")]
    return docs.select(
        get("op", "string").alias("op"),
        F.coalesce(*ids).alias("id"),
        get("before", ROW_SCHEMA).alias("before"),
        get("after", ROW_SCHEMA).alias("after"),
        get("source.file", "string").alias("file"),
        get("source.pos", "bigint").alias("pos"),
        get("source.row", "int").alias("row"),
        get("ts_ms", "bigint").alias("ts_ms"),
        *[get(path, kind).alias(name) for name, (path, kind) in (also or {}).items()],
    )


def change_order() -> Column:
    """Order of the changes of a key. Binlog files count up: the number at a
    file name's end is compared, as the names' lengths may differ."""
    number = F.regexp_extract("file", r"([0-9]+)$", 1).try_cast("decimal(38,0)")
    return F.struct(F.col("ts_ms"), number.alias("n"), F.col("file"), F.col("pos"), F.col("row"))


def cdc_apply(decoded: DataFrame) -> DataFrame:
    """The replica's current rows (id, first_name, last_name, email)."""
    return cdc_apply_with_deletes(decoded).filter(F.col("op") != F.lit("d")).select("after.*")


def cdc_merge(current: DataFrame, decoded: DataFrame) -> DataFrame:
    """Apply a batch of changes to an existing replica table: rows of keys
    without changes stay, changed keys take their last change, deleted keys go."""
    changes = cdc_apply_with_deletes(decoded)
    untouched = current.join(changes.select("id"), "id", "left_anti")
    return untouched.unionByName(changes.filter(F.col("op") != F.lit("d")).select("after.*"), allowMissingColumns=False)


def cdc_apply_with_deletes(decoded: DataFrame) -> DataFrame:
    """(id, op, after) of the last change of each key."""
    last = decoded.groupBy("id").agg(F.max_by(F.struct("op", "after"), change_order()).alias("last"))
    return last.select("id", F.col("last.op").alias("op"), F.col("last.after").alias("after"))
