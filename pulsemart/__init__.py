"""pulsemart: real-time retail analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` that works on a batch
DataFrame and, where Spark allows it, on a streaming one.  Layout:

* ``sources``   – test-table loading, stream adapters, stream sources, sinks
* ``functions`` – column expressions (parsing, time derivations, ids)
* ``operators`` – dedup, joins, aggregates, alert rule, change-feed routing
* ``plans``     – reports composed from operators and the query catalogue
* ``streaming`` – Structured Streaming twins of the batch operators
"""

from pulsemart.session import configure, get_session, work_dir

__all__ = ["configure", "get_session", "work_dir"]
