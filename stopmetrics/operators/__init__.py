"""Slices, profiles and quality checks over raw or staged stop events."""
