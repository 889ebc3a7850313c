"""Operators of a large-scale training-data pipeline (tokens, search, dedup, quality).

Nothing outside this subpackage imports it; ``queries`` registers one query per operator.
"""
