"""Scans, connectors and sinks."""

from quire.sources.tables import TABLES, load  # noqa: F401
