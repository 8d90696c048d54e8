"""Operators for training-data pipelines: de-duplication, search, scans, mixing, tokens.

Nothing else in the library imports this subpackage.
"""
