"""staffhouse: people-analytics operators and marts expressed as Spark DataFrame plans.

Layout
------
functions/   Column -> Column helpers (text cleaning, dates, money, bands, measures)
operators/   DataFrame -> DataFrame building blocks (unions, pivots, series, islands, checks)
sources/     schemas, readers for landed record streams and file exports, sinks
streaming/   incremental file ingest with anonymisation (Structured Streaming + foreachBatch)
plans/       the marts (one function per model), adapters from the driver tables, registered queries
"""

__version__ = "0.1.0"
