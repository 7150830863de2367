"""textloom: a Spark-native engine for building text and tabular datasets."""

__version__ = "0.1.0"
