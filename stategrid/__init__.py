"""stategrid: state-change ingestion, batching and telemetry queries on Spark.

Sub-packages:

* ``sources``   - event frames (text / JSON lines), decoding, the driver-table fixture
* ``functions`` - Column -> Column helpers (domains, number grammar, timestamps)
* ``operators`` - DataFrame -> DataFrame operators (state changes, batching,
                  counters, time series)
* ``plans``     - multi-step plans: two-level prefix windows, alert rules, panels,
                  the query registry used by ``__spark_entry__``
* ``sinks``     - Parquet tables partitioned by domain and month, JSON lines
* ``streaming`` - Structured Streaming wrappers and the stateful batcher
"""

__version__ = "0.1.0"
