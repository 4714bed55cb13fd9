"""hourglass: Spark-native hourly time-series ETL, features, scoring and back-testing.

Layout
------
sources/    readers, schema normalisation, sinks (S1-S10)
functions/  Column-expression builders: time, numeric, decision rules (P*, B1, B2, M16)
operators/  DataFrame -> DataFrame operators: series windows, dedup, joins,
            aggregates, sweeps, back-tests, metrics, folds, models
plans/      canonical derived inputs and the registered queries
streaming/  Structured Streaming ingest, SCD-1, resample, dedup
"""

__version__ = "0.1.0"
