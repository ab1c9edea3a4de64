"""Continuous intake."""
