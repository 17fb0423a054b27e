"""Operators for preparing large-scale training data.

Each module holds one operator with its own interface; ``queries`` registers
the thin ``opN_<name>`` queries and their DuckDB SQL.
"""
