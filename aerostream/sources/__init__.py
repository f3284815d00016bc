"""Batch and streaming sources (tables, files, Kafka, JDBC, catalogs)."""
