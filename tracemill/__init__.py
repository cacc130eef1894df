"""Spark-native analytics for agent-execution evidence."""
