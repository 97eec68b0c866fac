"""Spark-native translation-corpus engine."""
