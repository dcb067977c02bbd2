"""Mart builders, the daily run, the query registry and the SQL oracle."""
