"""Whole linkage runs and the registered queries."""
