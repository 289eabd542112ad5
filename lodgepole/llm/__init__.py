"""Operators for large-scale text corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers the ``opN_<name>`` queries over the tables.
"""
