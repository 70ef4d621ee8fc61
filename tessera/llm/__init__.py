"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. ``registry`` holds the
registered queries and their oracle SQL.
"""
