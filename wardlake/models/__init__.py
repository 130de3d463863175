"""Regression pipelines: features, training, registry and batch scoring."""
