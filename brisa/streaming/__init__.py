"""Structured Streaming: file drops, late corrections, running means and alerts."""
