"""strata: a PySpark-native library of DataFrame operators and plans.

Layout
------
``sources``    readers (JSON, documents, catalog tables, CSV variants, literal rows)
               and writers (dynamic-partition overwrite, CSV, append, by-name insert)
``functions``  Column-level helpers (ANSI-safe casts, text, dates, age bands)
``operators``  DataFrame -> DataFrame operators (interval overlap join, segment
               dedupe/closing, codebook encoding, nested flattening, statistics)
``plans``      end-to-end plans over the driver tables and the query registry
``streaming``  intentionally empty (no streaming semantics to reproduce)
"""

__version__ = "0.1.0"
