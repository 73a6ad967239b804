"""quire: batch and streaming data jobs on the public PySpark DataFrame, SQL and
Structured Streaming APIs.

Layout:
    quire.session     session factory and shared checkpoint / scratch folders
    quire.sources     scans, connectors and sinks (files, Kafka, JDBC, tables)
    quire.functions   column-expression builders (text, ticks, lookups, scores)
    quire.operators   the operators: aggregates, RFM, ticks/MACD, statistics
                      JSON, word count, change data capture, UDF surface
    quire.plans       the named queries over the driver tables and their oracles
    quire.streaming   Structured Streaming jobs (file/Kafka in, memory,
                      foreachBatch and Kafka out)
"""

__version__ = "0.1.0"
