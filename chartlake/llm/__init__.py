"""Operators for preparing training data, their queries and the corpus pipeline's parts.

Nothing outside this subpackage imports it; the entry module adds its queries where it is present.
"""
