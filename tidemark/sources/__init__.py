"""Readers and writers: logs and dumps as files, Kafka, and result tables."""
