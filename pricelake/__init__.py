"""pricelake: batch jobs over daily OHLCV price tables, written as Spark DataFrame plans.

Layers follow the warehouse convention raw -> staging -> intermediate -> marts:

* ``pricelake.sources``    scans (parquet, CSV with rejects, JSON), sinks, driver-table fixtures
* ``pricelake.functions``  Column-level helpers (safe divide, surrogate key, exact averages, ...)
* ``pricelake.operators``  DataFrame-in / DataFrame-out jobs (staging, series windows, marts,
                           incremental upsert, quality checks, job-log analyses, read models)
* ``pricelake.plans``      composition of the jobs into full / incremental builds and the
                           registered query catalog
* ``pricelake.streaming``  file-arrival driven incremental build (Structured Streaming)

Command line: ``python -m pricelake load|build|test --root <shared folder> ...``.
"""

__version__ = "0.1.0"
