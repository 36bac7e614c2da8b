"""Operators of a training-data pipeline (search, filters, dedup, scoring, tokens).

Each module holds one operator as a function of DataFrames; ``queries`` binds
them to the driver tables under the names ``opN_<name>``.  Nothing outside this
subpackage imports it.
"""
