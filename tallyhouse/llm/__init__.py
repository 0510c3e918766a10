"""Operators for building training corpora, each by one named method.

Every module holds one operator; ``queries`` applies them to whole tables.
Nothing else in the library imports this subpackage.
"""
