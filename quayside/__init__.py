"""quayside: a Spark-native engine for loading periodically published file collections.

Stages, each a DataFrame plan:

* ``operators.tasks``      catalog x period grid -> expected files (one row per URL)
* ``sources.archives``     zip archives -> members, on the executors
* ``operators.land``       CSV members -> partitioned landing tree, each member once
* ``operators.audit``      one audit row per archive, recent-success and gap queries
* ``streaming.ingest``     landing tree -> append-only table, exactly once, evolving schema
* ``plans.run``            the whole load in one function
"""

__version__ = "0.1.0"
