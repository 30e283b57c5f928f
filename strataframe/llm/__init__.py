"""Operators for preparing training text.

Each module holds one operator with its own general interface; ``queries``
holds the thin ``opN_<name>`` queries over the documents and pages tables.
Nothing outside this package imports it.
"""
