"""Pipelines made of the operators, one function per result table or group of tables."""
