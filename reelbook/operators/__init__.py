"""Extraction, quality, upsert and dashboard operators over DataFrames."""
