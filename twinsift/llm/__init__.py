"""Operators for training-data pipelines, one module each.

Nothing outside this subpackage imports it; ``queries.py`` holds the thin
registered queries and ``__spark_entry__`` adds them when the subpackage is
present.
"""
