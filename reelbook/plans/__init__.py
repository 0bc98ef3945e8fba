"""Registered queries, their expected results in SQL, and the pages they read."""
