"""Structured Streaming jobs: speed layer, click jobs, spend report."""
