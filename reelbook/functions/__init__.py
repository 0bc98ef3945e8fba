"""Column functions: text, time and VARIANT helpers."""
