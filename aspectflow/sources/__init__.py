"""Readers and writers: CSV, parquet, Kafka, JDBC, binary files, messages."""
