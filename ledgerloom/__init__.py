"""Spark-native analytics for EVM chain payloads and marketplace events."""
