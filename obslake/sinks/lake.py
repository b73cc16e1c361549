"""SNK-3: land raw documents as ``<root>/date=<d>/city=<c>/*.json``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from obslake.schema import BATCH_COL, SOURCE_COL


def land_documents(docs: DataFrame, root: str,
                   partition_cols: tuple[str, ...] = (BATCH_COL, SOURCE_COL),
                   mode: str = "append") -> None:
    """Write one JSON-lines file set per (batch, source) directory.

    The ``rebalance`` hint shuffles by the partition columns so each directory
    is written by few tasks (few files), and lets AQE split a hot
    (batch, source) that holds a large share of the rows across several tasks
    instead of one.
    """
    (docs.hint("rebalance", *partition_cols)
         .write.mode(mode)
         .partitionBy(*partition_cols)
         .json(root))
