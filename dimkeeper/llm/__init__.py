"""Operators for training-data pipelines.

Nothing outside this package imports it. Each module holds one operator; ``queries``
applies each to its whole table.
"""
