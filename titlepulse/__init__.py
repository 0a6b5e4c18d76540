"""titlepulse: review analytics on film titles, built on Spark DataFrames.

Layout:
  schemas        raw and result schemas, label constants
  session        session builder for local runs, shared scratch folder
  fixtures       raw movie / actor / review text tables derived from the test tables
  sources/       Kafka and file streams, JSON tables, the message envelope
  functions/     column expressions: cleaning, labels, text
  operators/     DataFrame -> DataFrame operators: cleaning, analytics, ingest,
                 mining, text model, look-ups, top-k
  streaming/     stream runner and idempotent micro-batch sinks
  plans/         named queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
