"""shopflow — a Spark-native retail data pipeline.

Layers (each a set of pure DataFrame -> DataFrame functions):

* ``sources``   — explicit-schema scans, the driver-table feeds, sinks.
* ``operators`` — cleaning (dedup / null-drop / casts / trim / fill) and
  data-quality checks (source expectations and model tests).
* ``functions`` — reusable Column expressions (safe casts, money rounding,
  validity predicate, time truncation).
* ``plans``     — staging views, marts and the ordered batch run.
* ``streaming`` — Structured Streaming ingest with bounded-state dedup,
  valid/invalid split, idempotent landing and a dead-letter table.
"""

__version__ = "0.1.0"
