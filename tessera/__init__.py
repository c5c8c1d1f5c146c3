"""tessera: reusable Spark DataFrame operators for geo/time, category, ranking,
graph and log-stream analytics.

Sub-packages:

* ``functions`` -- column expressions (time parsing, buckets, regex fields)
* ``operators`` -- DataFrame -> DataFrame operators (aggregates, ranking, joins,
  set ops, cleaning, graph algorithms)
* ``sources``   -- readers and sinks
* ``streaming`` -- Structured Streaming operators and the snapshot sink
* ``plans``     -- the composite analytics (query catalogue) over the test tables
"""

__version__ = "0.1.0"
