"""Replay of append logs as streams."""
