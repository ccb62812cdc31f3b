"""ledgerline: keep a large registry table in step with landed snapshots, on Spark.

Every operator takes DataFrames (plus parameters) and returns a DataFrame.
Readers live in ``sources``, writers in ``sinks``, composite jobs in ``plans``.
"""

__version__ = "0.1.0"
