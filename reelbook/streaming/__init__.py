"""Streams: messages to landed pages, landed pages to tables, latest state per key."""
