"""Readers and writers of messages, raw pages, processed JSON and tables."""
