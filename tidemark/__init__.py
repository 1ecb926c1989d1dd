"""Tidemark: time-binned message logs and measurement data as Spark DataFrames.

Every operator takes and returns DataFrames. ``functions`` holds Column
expressions, ``operators`` the single steps, ``plans`` the pipelines made of them,
``sources`` the readers and writers and ``streaming`` the Structured Streaming forms.
"""
