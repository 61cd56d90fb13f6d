"""Operators for large training-data pipelines.

One module per operator, plus ``queries`` (the registered ``opN_`` queries)
and ``oracle`` (their DuckDB SQL).  Nothing else in the library imports this
subpackage.
"""
