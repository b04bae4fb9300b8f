"""salesq — Spark-native sales-data quality, modelling and reconciliation engine.

Every operator is a ``DataFrame -> DataFrame`` transformation built from
built-in Spark SQL expressions, joins, aggregates and windows, so Catalyst
can push filters into scans, prune columns and pick join strategies.
"""

__version__ = "0.1.0"
