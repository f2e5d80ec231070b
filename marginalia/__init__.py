"""marginalia: a Spark-native engine for bibliographic snapshots and training-data preparation."""

__version__ = "0.1.0"
