"""txrisk: transaction-risk analytics as composable Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the work is
declared with the DataFrame API so Catalyst/AQE plan it.  Sub-packages:

* ``sources``   -- scans and sinks (CSV, partitioned Parquet, the events adapter)
* ``functions`` -- column-level helpers (exact rounding, flags, vectors)
* ``operators`` -- filters, profiles, account features, velocity windows,
                   reconciliation, sampling, metrics, MLlib model stages
* ``plans``     -- the end-to-end stages and the registered query catalog
* ``streaming`` -- Structured Streaming velocity scoring
"""

__version__ = "0.1.0"
