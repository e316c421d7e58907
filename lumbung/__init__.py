"""Lumbung: a Spark-native engine for turning landed news feeds and pages into analysis-ready tables."""
