"""Operators for preparing training data; their queries are in ``queries``, the SQL in ``sql``."""
