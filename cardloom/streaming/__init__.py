"""Streaming jobs: clean, score, monitor."""
