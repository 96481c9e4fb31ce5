"""ledgerlake: a PySpark-native payments lakehouse.

Operators are pure DataFrame functions (``ledgerlake.operators``); the
``Lake`` class persists them as Parquet tables; ``ledgerlake.plans``
composes them into the nightly run; ``ledgerlake.streaming`` runs the same
ingest as Structured Streaming.
"""
__version__ = "0.1.0"
