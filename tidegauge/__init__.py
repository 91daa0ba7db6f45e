"""Observability analytics on Spark: OTLP decoding, resampling, features and training tables."""
