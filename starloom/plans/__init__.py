"""Extracts, dimensions, facts, loads and the full run."""
