"""Readers and writers for lake files, messages and batches."""
