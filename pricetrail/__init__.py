"""Snapshot-history analytics as Spark jobs.

Layout: ``functions`` holds Column expressions, ``sources`` the readers, writers
and the page parser, ``operators`` the DataFrame operators, ``streaming`` their
Structured Streaming forms and ``plans`` the queries over the benchmark tables.
"""
