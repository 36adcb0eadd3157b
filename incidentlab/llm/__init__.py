"""Training-data operators: dedup, decontamination, classifiers, scans, mixing.

One module per operator, each with a general DataFrame interface;
``queries.py`` holds the registered queries and their DuckDB SQL.
"""
