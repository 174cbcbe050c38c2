"""eventide: activity-stream analytics on Spark.

Nested JSON activity events are parsed, validated, de-duplicated and enriched
with built-in column expressions, aggregated into a raw table and four
sliding-window metric tables (the same functions for batch DataFrames and
Structured Streaming), and served through summary reports and dashboard
panel queries.

Subpackages: ``sources`` (record streams, landing, table readers),
``functions`` (parsing, time ranges), ``operators`` (quality, enrichment,
metrics, maintenance), ``plans`` (pipeline, reports, panels, batch table
build, the named queries and their SQL oracle), ``streaming`` (sinks, the
streaming job).
"""
