"""strata — change-feed lakehouse operators on Spark DataFrames.

Subpackages:
  sources    — fixture/table loading, manifest + positional CSV ingest, schema tools, sinks
  functions  — column-level helpers (keys, cleansing, governance expressions)
  operators  — table-level operators (change application, history, joins, quality, control, layout)
  plans      — the Silver → Gold model composed from operators, plus business questions
  streaming  — Structured Streaming counterparts of the batch operators
"""

__version__ = "0.1.0"
