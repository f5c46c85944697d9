"""Operators on texts for model training: packing into containers, mixing sources, subjects of documents.

Nothing outside this package imports it.
"""
