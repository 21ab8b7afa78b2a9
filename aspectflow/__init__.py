"""aspectflow: review-sentiment and traffic-camera analytics on Spark.

Everything is expressed with the DataFrame API, Spark ML and (where the
semantics need Python) Arrow pandas UDFs.  Sub-packages:

* ``functions`` - column expressions (text cleaning, argmax, JSON, base64 ...)
* ``operators`` - DataFrame -> DataFrame operators (vocabulary, metrics,
  frames, dashboard, history, registry)
* ``sources``   - readers and writers (CSV, parquet, Kafka, JDBC, files)
* ``streaming`` - Structured Streaming pipelines with replay-safe sinks
* ``ml``        - multi-head aspect classifier on Spark ML
* ``plans``     - the registered queries over the driver tables
"""

from aspectflow.session import get_spark, shared_path  # noqa: F401

__all__ = ["get_spark", "shared_path"]
