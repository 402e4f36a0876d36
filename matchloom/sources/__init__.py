"""Reading, writing and validating tables."""
