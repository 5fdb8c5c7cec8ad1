"""microlake: Spark-native medallion analytics for yearly delimited microdata."""

__version__ = "0.1.0"
