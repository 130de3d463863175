"""Discharge analytics on Spark: lake ingest, query catalogue, model training and scoring."""
