"""Rule tables (data only). See ``scoring`` and ``bands``."""
