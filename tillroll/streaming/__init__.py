"""Event-time operators that work alike on tables and on streams."""
