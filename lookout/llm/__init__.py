"""Operators for building training corpora: deduplication, filtering, sanitising, mixing and packing.

Each module holds one operator with its own interface; ``queries`` registers a query for each over the given tables.
Nothing outside this subpackage imports it.
"""
