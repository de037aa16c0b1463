"""Operators for large text collections used to train language models.

Every operator tagged llm lives here, with its queries and SQL.  The rest of the library
never imports this subpackage; it may be removed without any effect on the rest.
"""
