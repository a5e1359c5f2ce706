"""Operators for building training data: one module per operator, each over whole tables.

Nothing outside this subpackage imports it. ``registry`` holds the registered queries and their SQL.
"""
