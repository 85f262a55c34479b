"""Operators of a training-data pipeline; ``queries`` and ``oracle_sql`` are added to the entry when present."""
