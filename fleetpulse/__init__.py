"""fleetpulse: vehicle-telemetry analytics on Spark DataFrames.

Layers, each a set of pure DataFrame -> DataFrame functions with I/O at the
edges:

* ``sources``   - readers (event envelopes, CSV/JSON reference files, nested
                  payloads, landing folders) and sinks (table writes,
                  insert-only merges, publish payloads).
* ``functions`` - column expressions (typed times, delay classes, flags,
                  exact rounded averages).
* ``operators`` - cleaning, deduplication, enrichment, gold summaries and
                  serving queries.
* ``streaming`` - Structured Streaming ingest and incremental twins of the
                  batch operators.
* ``plans``     - the silver build, the ordered pipeline and the query
                  registry used by ``__spark_entry__``.
"""

__version__ = "0.1.0"
