"""Readers: stored tables, landed pages, the JSON block inside a page."""
