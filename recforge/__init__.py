"""recforge: Spark-native feature, embedding and candidate jobs for recommenders.

Every operator takes and returns DataFrames and is built from Spark SQL
expressions, joins, aggregates and windows; see README.md for the map.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
