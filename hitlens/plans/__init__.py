"""Derived test tables, the query registry and its SQL oracles."""
