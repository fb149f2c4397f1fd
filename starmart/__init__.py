"""starmart: a Spark-native retail star-schema warehouse.

Layers
------
- ``sources``    readers for the five OLTP tables (parquet / CSV) and the
                 test-data adapter that maps the driver's TPC-H-style tables
                 onto them.
- ``functions``  column expressions (date keys, calendar attributes, blank
                 tests, change predicates, money rounding, index pick).
- ``operators``  DataFrame -> DataFrame building blocks: extract, clean,
                 surrogate keys, SCD-1 / SCD-2 dimensions, idempotent fact
                 load, maintenance updates, data-quality checks, analytics.
- ``plans``      composed jobs: in-memory star build, the on-disk warehouse
                 with its commit protocol, and the batch runner.
- ``streaming``  the hourly batch as a Structured Streaming query.
"""

__version__ = "0.1.0"
