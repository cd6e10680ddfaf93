"""Whole runs: landed pages in, next versions of the stored tables out."""
