"""wakeframe: Spark-native analytics for per-frame sensor sequences."""

__version__ = "0.1.0"
