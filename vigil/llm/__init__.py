"""Operators of a training-data pipeline, each one Spark job graph.

Modules are named after what they do; ``queries`` holds the thin contract
queries and their oracle SQL. Nothing outside this subpackage imports it.
"""
