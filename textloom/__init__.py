"""textloom: a Spark-native engine for preparing and accounting for text corpora."""

__version__ = "0.1.0"
