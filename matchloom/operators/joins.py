"""Joins whose size Spark can't foretell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def by_key(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join that deals both sides out by key, and so never sends a whole side through the driver.

    Spark takes exploded rows, built texts and vectors for as small as the file that they come from, broadcasts them on that
    ground, and keeps to it even once it has counted them, as the other plan would take more shuffles.
    """
    return left.hint("merge").join(right, on, how)
