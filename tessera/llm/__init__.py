"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their DuckDB SQL; every other module is one operator or
a helper shared by several.
"""
