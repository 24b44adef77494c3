"""Spark-native engine for activity data: normalise, upsert, snapshot, model, check."""
