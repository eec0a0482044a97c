"""Runs driven by arriving files."""
