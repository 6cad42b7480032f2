"""Gleaner: a Spark-native engine for transcript evidence and corpus preparation."""
