"""Operators for building training corpora.

Nothing else in the library imports this subpackage; its queries are added to
the registry only when it can be imported.
"""
