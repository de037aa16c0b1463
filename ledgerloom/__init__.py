"""Spark-first analytics over provenance-carrying scientific evidence.

Operators are pure functions from DataFrames to DataFrames; nothing here holds a
session.  ``operators`` has the data-processing operators, ``functions`` column
expressions, ``sources`` readers and writers, ``plans`` the named queries with their
SQL counterparts, ``streaming`` the structured-streaming forms.  ``llm`` is an optional
subpackage for training-data text; nothing outside it imports it.
"""

__version__ = "0.1.0"
