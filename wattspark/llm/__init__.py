"""Operators of a training-data pipeline (one module each) and their queries.

Nothing outside this package imports it; ``catalog`` registers its queries.
"""
