"""Candidates for records as they arrive, against a fixed set of queries. An extension; whole runs stay batch runs.

Context features need every candidate of a query, so a micro-batch is only blocked here, never decided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.normalize import normalize_frame
from ..operators import blocking


def block_arriving(arriving: DataFrame, s1: DataFrame, target: str, checkpoint: str, config: blocking.BlockingConfig = blocking.BlockingConfig(), only: tuple[str, ...] = ("digit", "address", "street")):
    """Starts a query that appends each micro-batch's candidates to target. s1 is normalised already; weights are those of the batch."""

    def one(batch: DataFrame, number: int) -> None:
        found = blocking.retrieval.union_passes(blocking.passes(s1, normalize_frame(batch), config, only=only))
        found.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return arriving.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).start()
