"""Spark-native analytics for versioned document collections."""
