"""innkeeper: short-term-rental star-schema analytics on Spark.

Layers: ``sources`` (typed CSV / Parquet scans and sinks, stand-in extracts),
``functions`` (column parsers), ``operators`` (dedup, keys, lookups, quality
rules, metrics), ``plans`` (staging, warehouse, business questions, pipelines).
"""

__version__ = "0.1.0"
