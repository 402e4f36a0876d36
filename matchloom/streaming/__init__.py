"""Scoring of arriving records."""
