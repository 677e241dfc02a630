"""Sedimenta: a Spark-native engine for archived forum pages and training corpora."""
