"""packflow: Spark-native supply-chain panel analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` transformation built from
``pyspark.sql.functions`` / ``Window`` / MLlib; actions happen only in sinks,
model fits and the bounded loops (route relaxation, revision rounds).
"""

__version__ = "0.1.0"
