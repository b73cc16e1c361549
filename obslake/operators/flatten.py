"""PRJ-1, PRJ-4: struct flatten with carried columns, provenance label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from obslake.functions.expr import source_from_path
from obslake.schema import BATCH_COL, SOURCE_COL


def flatten(raw: DataFrame, struct_col: str = "current",
            carry: Sequence[str] = (BATCH_COL, "latitude", "longitude"),
            path_col: str = "file_path") -> DataFrame:
    """Star-expand the measurement struct, carry document-level columns, and
    label each row with the source named by its file path (not by the
    document body).  A discovered ``city=`` partition column, if any, is
    replaced by the path-derived value, which is defined for both layouts."""
    carry = [c for c in carry if c in raw.columns]
    cols = [f"{struct_col}.*", *carry]
    if path_col in raw.columns:
        cols.append(path_col)
    out = raw.select(*cols)
    if path_col in raw.columns:
        out = out.withColumn(SOURCE_COL, source_from_path(path_col))
    return out

