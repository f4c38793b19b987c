"""Slowly changing dimensions on Spark: merge, history, previous values and versions."""
