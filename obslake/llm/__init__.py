"""Training-data operators (documents, pages, benchmark, labels).

Nothing outside this package imports it.  ``queries.py`` holds the registered
queries, ``oracle.py`` their DuckDB SQL.  Every operator takes DataFrames and
column names, and selects the columns it needs first, so extra columns with
clashing names cannot reach its plans.
"""
