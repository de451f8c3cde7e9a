"""Training-data operators: quality, dedup, tokens, mixing, packing.

Self-contained: nothing else in the library imports this subpackage.  Each
module is one operator with its own general interface; ``queries`` holds the
thin registered queries and ``oracle`` their DuckDB SQL where SQL can say it.
"""
