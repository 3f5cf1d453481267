"""Spark-native analytics for IoT sensor readings, in batch and in stream."""
