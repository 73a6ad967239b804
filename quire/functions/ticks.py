"""Market tick record expressions.

A tick is one comma-delimited text record; field 0 is the instrument key,
field 31 the date (yyyy-MM-dd) and field 32 the time (HH:mm:ss). A record is
valid with more than 30 fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import field, split_fields

# The positions used by the reference's indicator rows.
KEY_FIELD = 0
OBV_FIELD = 11
AMO_FIELD = 12
DATE_FIELD = 31
TIME_FIELD = 32
MIN_FIELDS = 31  # "more than 30 fields"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def decode_record(value: Column) -> Column:
    """A payload that is a JSON string literal (``"a,b,..."``) is
    unquoted; plain text passes through."""
    # Only quoted payloads go through the JSON reader: a failed JSON parse
    # costs an exception per record.
    return F.when(value.startswith('"'), F.coalesce(F.get_json_object(value, "$"), value)).otherwise(value)


def tick_fields(line: Column) -> Column:
    return split_fields(line, ",")


def is_valid(fields: Column) -> Column:
    """More than 30 fields."""
    return F.size(fields) >= F.lit(MIN_FIELDS)


def number(fields: Column, i: int) -> Column:
    """Field ``i`` as a double; null when missing or not a number (the
    reference's ``.toDouble`` would fail the job instead)."""
    return field(fields, i).try_cast("double")


def event_time(fields: Column) -> Column:
    """Fields 31 and 32 to a timestamp (null when malformed)."""
    return F.try_to_timestamp(
        F.concat_ws(" ", field(fields, DATE_FIELD), field(fields, TIME_FIELD)), F.lit(TIME_FORMAT)
    )


def body_lines(body: Column) -> Column:
    """A quote-feed response body to its ``;``-separated entries."""
    return F.split(body, ";", -1)


def entry_to_record(entry: Column) -> Column:
    """``var hq_str_<key>="f1,f2,..."`` to ``<key>,f1,f2,...``: third
    ``_`` piece, ``=`` to ``,``, quotes dropped."""
    third = F.get(F.split(entry, "_", -1), 2)
    return F.replace(F.replace(third, F.lit("="), F.lit(",")), F.lit('"'), F.lit(""))
