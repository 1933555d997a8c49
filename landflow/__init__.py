"""landflow: near-real-time file-to-published-table processing on PySpark.

Every operator is a pure ``DataFrame(s) -> DataFrame(s)`` function.  Nothing in
``functions``, ``operators`` or ``plans.entity_load`` triggers a Spark job; only
the sinks in ``sources.sinks`` and ``plans.publish`` do.
"""

__version__ = "0.1.0"
