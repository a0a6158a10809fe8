"""Spark-native daily-bar (OHLCV) analytics: ingest, clean, enrich, marts, views, quality.

Subpackages: ``sources`` (CSV, messages, tables), ``operators`` (clean,
features, marts, views, signals, quality), ``functions`` (column and SQL
expressions), ``plans`` (silver, layers, chain, skew handling, storage,
sizing), ``streaming`` (message stream -> bronze). Every operator takes and
returns DataFrames; the caller owns the SparkSession.
"""

__version__ = "0.1.0"
