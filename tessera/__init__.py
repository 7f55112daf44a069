"""tessera: Spark-native operators for web-log traffic analysis, categorical
profiling and encoding, deterministic splits, oracle-checkable metrics,
two-part (gate + severity) models and rating-based recommendation.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` expressions, joins, windows and spark.ml
estimators; the Spark planner chooses the physical strategy.
"""

__version__ = "0.1.0"
